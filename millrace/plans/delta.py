"""Marts kept up to date from the rows that changed.

What changed is two frames, rows that came and rows that were taken back. Each becomes signed partial aggregates,
so that one grouped pass over the change gives what to add to each group:

* sums and counts are additive, with the sign;
* a distinct count follows from a table of multiplicities (group, value, n): it changes by the values that appear or go;
* a minimum or maximum takes new rows at once. Only where rows equal to it are taken back has the group lost its witness, and
  only such groups are computed again from the base table;
* top rows are ranked again in the buckets that changed, from the table of all groups' counts, not from raw rows.

Groups are dropped when their last row goes. The state is a set of plain tables; apply() returns the rows to put in their place (`changed`) and the keys that
go (`gone`), for an upsert or for buckets overwritten as a whole. A row taken back must have been counted before; keys may be null.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources import layout


@dataclass(frozen=True)
class View:
    keys: tuple[str, ...]
    #: name: an expression that gives each row's number, summed (null counts as 0); `rows`, the number of rows, is always kept
    sums: dict[str, str] = field(default_factory=dict)
    #: name: column whose distinct values are counted
    distinct: dict[str, str] = field(default_factory=dict)
    #: name: columns of which the smallest or largest is kept
    least: dict[str, str] = field(default_factory=dict)
    largest: dict[str, str] = field(default_factory=dict)


class State(NamedTuple):
    #: keys, rows, and the named measures
    groups: DataFrame
    #: keys, value, n for each distinct count
    values: dict[str, DataFrame]


class Change(NamedTuple):
    changed: State
    gone: DataFrame
    #: keys of the groups that had lost a minimum or maximum
    lost: DataFrame


def _same(keys: tuple[str, ...], left: str, right: str) -> Column:
    on = F.lit(True)
    for k in keys:
        on = on & F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}"))
    return on


def _extremes(view: View, of: Column | None = None) -> list[Column]:
    def only(c: str) -> Column:
        return F.col(c) if of is None else F.when(of, F.col(c))

    return [F.min(only(c)).alias(n) for n, c in view.least.items()] + [F.max(only(c)).alias(n) for n, c in view.largest.items()]


def _sums(view: View, sign: Column) -> list[Column]:
    return [F.sum(sign).alias("rows")] + [F.sum(F.coalesce(F.expr(c), F.lit(0)) * sign).alias(n) for n, c in view.sums.items()]


def _values(rows: DataFrame, view: View, column: str, sign: Column) -> DataFrame:
    """keys, value, n: how often each value came, less how often it went."""
    return rows.where(F.col(column).isNotNull()).groupBy(*view.keys, F.col(column).alias("value")).agg(F.sum(sign).alias("n"))


def full(rows: DataFrame, view: View) -> State:
    """The state of all rows: where to start, and what every change has to agree with."""
    one = F.lit(1).cast("long")
    groups = rows.groupBy(*view.keys).agg(*_sums(view, one), *(F.countDistinct(c).alias(n) for n, c in view.distinct.items()), *_extremes(view))
    return State(groups, {n: _values(rows, view, c, one) for n, c in view.distinct.items()})


def apply(state: State, view: View, came: DataFrame, went: DataFrame | None, base: DataFrame) -> Change:
    """What a change does to the state. base has the rows after it, and is read only where a minimum or maximum lost its witness: not at all
    if nothing went, or if the view has neither. came and went should be stored: each is read a few times."""
    keys = view.keys
    rows = came.withColumn("_sign", F.lit(1).cast("long"))
    if went is not None:
        rows = rows.unionByName(went.withColumn("_sign", F.lit(-1).cast("long")))
    sign = F.col("_sign")
    plus = sign > 0
    minus = [F.min(F.when(~plus, F.col(c))).alias(f"_out_{n}") for n, c in view.least.items()]
    minus += [F.max(F.when(~plus, F.col(c))).alias(f"_out_{n}") for n, c in view.largest.items()]
    delta = rows.groupBy(*keys).agg(*_sums(view, sign), *_extremes(view, plus), *minus)

    # multiplicities, and by how much each distinct count changes
    values, steps = {}, {}
    for name, column in view.distinct.items():
        new = _values(rows, view, column, sign).where("n <> 0")
        pair = (*keys, "value")
        met = new.alias("d").join(state.values[name].alias("s"), _same(pair, "d", "s"), "left")
        both = met.select(*(F.col(f"d.{k}").alias(k) for k in pair), F.coalesce("s.n", F.lit(0)).alias("before"), (F.coalesce("s.n", F.lit(0)) + F.col("d.n")).alias("n"))
        values[name] = both.select(*pair, "n")
        steps[name] = both.groupBy(*keys).agg(F.sum((F.col("n") > 0).cast("long") - (F.col("before") > 0).cast("long")).alias("step"))

    at = delta.alias("d").join(state.groups.alias("s"), _same(keys, "d", "s"), "left")
    columns = [F.col(f"d.{k}").alias(k) for k in keys]
    columns += [(F.coalesce(f"s.{n}", F.lit(0)) + F.col(f"d.{n}")).alias(n) for n in ("rows", *view.sums)]
    columns += [F.coalesce(f"s.{n}", F.lit(0)).alias(n) for n in view.distinct]
    columns += [F.least(f"s.{n}", f"d.{n}").alias(n) for n in view.least] + [F.greatest(f"s.{n}", f"d.{n}").alias(n) for n in view.largest]
    # a row that equals the old extreme is taken back, and no row that came is at least as extreme
    lost = F.lit(False)
    for n in view.least:
        lost = lost | F.coalesce((F.col(f"d._out_{n}") <= F.col(f"s.{n}")) & F.coalesce(F.col(f"d.{n}") > F.col(f"s.{n}"), F.lit(True)), F.lit(False))
    for n in view.largest:
        lost = lost | F.coalesce((F.col(f"d._out_{n}") >= F.col(f"s.{n}")) & F.coalesce(F.col(f"d.{n}") < F.col(f"s.{n}"), F.lit(True)), F.lit(False))
    merged = at.select(*columns, lost.alias("_lost"))
    for name, step in steps.items():
        met = merged.alias("m").join(step.alias("t"), _same(keys, "m", "t"), "left")
        merged = met.select(*(F.col(f"m.{c}").alias(c) if c != name else (F.col(f"m.{c}") + F.coalesce("t.step", F.lit(0))).alias(c) for c in merged.columns))

    gone = merged.where("rows = 0").select(*keys)
    lost = merged.where("rows > 0 AND _lost").select(*keys)
    left = merged.where("rows > 0")
    names = [*keys, "rows", *view.sums, *view.distinct, *view.least, *view.largest]
    if went is not None and (view.least or view.largest):
        again = base.alias("b").join(lost.alias("l"), _same(keys, "b", "l"), "left_semi").groupBy(*keys).agg(*_extremes(view))
        met = left.alias("m").join(again.alias("a"), _same(keys, "m", "a"), "left")
        anew = {*view.least, *view.largest}
        left = met.select(*(F.when(F.col("m._lost"), F.col(f"a.{c}")).otherwise(F.col(f"m.{c}")).alias(c) if c in anew else F.col(f"m.{c}").alias(c) for c in names))
    return Change(State(left.select(*names), values), gone, lost)


def merged(state: State, change: Change, view: View) -> State:
    """The whole state after the change, for stores without an upsert: unchanged rows, and the changed ones."""

    def put(old: DataFrame, new: DataFrame, gone: DataFrame | None, keys: tuple[str, ...]) -> DataFrame:
        touched = new.select(*keys) if gone is None else new.select(*keys).unionByName(gone)
        return old.alias("o").join(touched.alias("t"), _same(keys, "o", "t"), "left_anti").select(*new.columns).unionByName(new)

    values = {n: put(state.values[n], v, None, (*view.keys, "value")).where("n > 0") for n, v in change.changed.values.items()}
    return State(put(state.groups, change.changed.groups, change.gone, view.keys), values)


def top_changed(groups: DataFrame, change: Change, bucket: tuple[str, ...], order: list[Column], top: int) -> DataFrame:
    """The top rows of the buckets that the change touched, ranked anew from groups (the state after it); rank is a column of its own.

    A bucket that has lost all its rows gives none: remove the touched buckets before these rows are added."""
    touched = change.changed.groups.select(*bucket).unionByName(change.gone.select(*bucket)).distinct()
    seen = groups.alias("g").join(touched.alias("t"), _same(bucket, "g", "t"), "left_semi")
    return seen.withColumn("rank", F.row_number().over(Window.partitionBy(*bucket).orderBy(*order))).where(F.col("rank") <= top)


#: The column that a stored state is partitioned by: p and the text of its expression, or none.
PART = "part"


def _files(view: View) -> dict[str, str]:
    return {"": "groups"} | {n: f"values-{k}" for k, n in enumerate(view.distinct)}


def _part(part: str) -> Column:
    return F.coalesce(F.concat(F.lit("p"), F.expr(part).cast("string")), F.lit("none")).alias(PART)


def store(state: State, view: View, root: str, part: str) -> None:
    """Writes a state to files by part, an expression over the keys (the day of a minute, say)."""
    for name, path in _files(view).items():
        rows = state.values[name] if name else state.groups
        layout.write_parts(rows.select("*", _part(part)), f"{root}/{path}", PART)


def stored(spark: SparkSession, view: View, root: str) -> State:
    """The state that is stored. Parts that lost all their rows hold a row of count 0, which is not shown."""
    read = {n: spark.read.parquet(f"{root}/{p}") for n, p in _files(view).items()}
    return State(read[""].where("rows > 0"), {n: read[n].where("n > 0") for n in view.distinct})


def update(spark: SparkSession, view: View, root: str, part: str, came: DataFrame, went: DataFrame | None, base: DataFrame) -> None:
    """Applies a change to a stored state. Only parts that the change falls into are read (the second scan's filter is what the first has found)
    and written anew. The new parts are written beside the old ones first, and then put in their place: what reads the old state is done by then, on whatever executor,
    and where that second step is cut short, finish() does it again."""
    rows = came if went is None else came.unionByName(went)
    touched = rows.select(_part(part)).distinct()
    old = stored(spark, view, root)

    def near(x: DataFrame) -> DataFrame:
        return x.join(F.broadcast(touched), PART, "left_semi").drop(PART)  # at most as many values as there are parts

    was = State(near(old.groups), {n: near(v) for n, v in old.values.items()})
    new = merged(was, apply(was, view, came, went, base), view)
    for name, path in _files(view).items():
        frame, count = (new.values[name], "n") if name else (new.groups, "rows")
        empty = touched.withColumn(count, F.lit(0).cast("long"))
        frame = frame.select("*", _part(part))
        frame.unionByName(empty, allowMissingColumns=True).select(*frame.columns).write.mode("overwrite").parquet(f"{root}/next/{path}")
    finish(spark, view, root)


def finish(spark: SparkSession, view: View, root: str) -> None:
    """Puts the parts that update() wrote last in their place; doing so again changes nothing."""
    for path in _files(view).values():
        layout.write_parts(spark.read.parquet(f"{root}/next/{path}"), f"{root}/{path}", PART)
