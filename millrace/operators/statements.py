"""SQL statements with parameters: values are markers, names go through IDENTIFIER(), nothing is pasted into text."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession

from . import analysis


def name(*parts: str) -> str:
    """A name of one or more parts as IDENTIFIER() takes it: each part between backticks."""
    return ".".join(f"`{p.replace('`', '``')}`" for p in parts)


def run(spark: SparkSession, sql: str, args: dict[str, Any] | None = None, **frames: DataFrame) -> DataFrame:
    """Runs exactly one statement, with :markers from args and {frames} as tables."""
    return spark.sql(analysis.single(sql), args=args or None, **frames)


def with_counts(parents: DataFrame, children: DataFrame, key: str) -> DataFrame:
    """parents with n, the number of children of equal key, by a correlated scalar subquery."""
    sql = "SELECT p.*, (SELECT count(*) FROM {children} c WHERE IDENTIFIER('c.' || :key) = IDENTIFIER('p.' || :key)) AS n FROM {parents} p"
    return run(parents.sparkSession, sql, {"key": name(key)}, parents=parents, children=children)


def insert(spark: SparkSession, table: str, rows: list[dict[str, Any]]) -> None:
    """Appends a few rows given as values; columns that a row lacks are null. table is a name as SQL has it.

    Every column is named, in the rows' order of first use, so a table with other columns besides keeps them null."""
    columns = list(dict.fromkeys(c for r in rows for c in r))
    if not columns:
        return
    args: dict[str, Any] = {"t": table} | {f"c{k}": name(c) for k, c in enumerate(columns)}
    lines = []
    for i, r in enumerate(rows):
        for k, c in enumerate(columns):
            if r.get(c) is not None:
                args[f"v{i}_{k}"] = r[c]
        lines.append("(" + ", ".join(f":v{i}_{k}" if r.get(c) is not None else "NULL" for k, c in enumerate(columns)) + ")")
    into = ", ".join(f"IDENTIFIER(:c{k})" for k in range(len(columns)))
    run(spark, f"INSERT INTO IDENTIFIER(:t) ({into}) VALUES {', '.join(lines)}", args)


def among(df: DataFrame, column: str, values: list[Any]) -> DataFrame:
    """The rows whose column is one of the values, which are markers however they are written."""
    if not values:
        return df.where("false")
    args = {"c": name(column)} | {f"v{k}": v for k, v in enumerate(values)}
    marks = ", ".join(f":v{k}" for k in range(len(values)))
    return run(df.sparkSession, f"SELECT * FROM {{df}} WHERE IDENTIFIER(:c) IN ({marks})", args, df=df)


def grouped_report(spark: SparkSession, table: str, key: str, newest: str, top: int = 10) -> DataFrame:
    """key, n, newest: a table's most frequent keys, ties by key, with the newest time of each."""
    sql = """SELECT IDENTIFIER(:key) AS key, count(*) AS n, max(IDENTIFIER(:newest)) AS newest FROM IDENTIFIER(:t)
      WHERE IDENTIFIER(:key) IS NOT NULL GROUP BY 1 ORDER BY n DESC, key LIMIT :top"""
    return run(spark, sql, {"t": table, "key": name(key), "newest": name(newest), "top": top})
