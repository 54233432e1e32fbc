"""Models and gates as one build: each model a DataFrame of the models it needs, each gate a search for rows that must not be there.

Models are built in topological order and written; then their gates run over what was written. A model whose gate fails, or that fails itself, stops
exactly its descendants: they are skipped, and all others are built. Each model stays a plain DataFrame plan over tables.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame, SparkSession

Tables = dict[str, DataFrame]


@dataclass(frozen=True)
class Model:
    name: str
    build: Callable[[Tables], DataFrame]
    needs: tuple[str, ...] = ()


@dataclass(frozen=True)
class Gate:
    """Fails where rows() has more than `most` rows. It sees its model and the models in needs; a warning stops nothing."""

    name: str
    model: str
    rows: Callable[[Tables], DataFrame]
    needs: tuple[str, ...] = ()
    most: int = 0
    warns: bool = False


def ordered(models: list[Model], gates: list[Gate]) -> list[str]:
    """The names so that each comes after what it needs and after what its gates need; a circle or an unknown name is an error."""
    known = {m.name: set(m.needs) for m in models}
    if len(known) < len(models):
        raise ValueError("two models have one name")
    for g in gates:
        if g.model not in known:
            raise ValueError(f"gate {g.name} is of no model: {g.model}")
        known[g.model] |= set(g.needs)
    for name, needs in known.items():
        if unknown := needs - known.keys():
            raise ValueError(f"{name} needs no model: {', '.join(sorted(unknown))}")
    return list(TopologicalSorter({k: sorted(v) for k, v in known.items()}).static_order())


def selected(models: list[Model], select: list[str] | None) -> set[str]:
    """Names by selectors: `a` itself, `+a` with all it needs, `a+` with all that hangs on it."""
    needs = {m.name: set(m.needs) for m in models}
    if select is None:
        return set(needs)

    def closure(of: str, step: dict[str, set[str]]) -> set[str]:
        seen, todo = set(), [of]
        while todo:
            x = todo.pop()
            if x not in seen:
                seen.add(x)
                todo += step[x]
        return seen

    back = {n: {m for m in needs if n in needs[m]} for n in needs}
    out: set[str] = set()
    for s in select:
        n = s.strip("+")
        if n not in needs:
            raise ValueError(f"no model {n}")
        out |= {n} | (closure(n, needs) if s.startswith("+") else set()) | (closure(n, back) if s.endswith("+") else set())
    return out


def run(spark: SparkSession, root: str, models: list[Model], gates: list[Gate], select: list[str] | None = None) -> DataFrame:
    """Builds what is selected into root/<name>; what isn't is read from there where it is needed. A row for each model and each gate:
    model, gate (null for the model itself), status (built, failed, skipped, passed, warned), found (a gate's rows, null if it did not run), reason."""
    of, chosen = {m.name: m for m in models}, selected(models, select)
    held: set[str] = set()  # failed, or hanging on what has
    rows: list[tuple] = []

    def tables(names: tuple[str, ...]) -> Tables:
        return {n: spark.read.parquet(f"{root}/{n}") for n in names}

    for name in ordered(models, gates):
        if name not in chosen:
            continue
        model, own = of[name], [g for g in gates if g.model == name]
        if stopped := sorted(set(model.needs) & held):
            held.add(name)
            rows.append((name, None, "skipped", None, f"needs {', '.join(stopped)}"))
            rows += [(name, g.name, "skipped", None, None) for g in own]
            continue
        try:
            model.build(tables(model.needs)).write.mode("overwrite").parquet(f"{root}/{name}")
        except Exception as e:  # one model's fault: it is reported, and stops its descendants alone
            held.add(name)
            rows.append((name, None, "failed", None, str(e)[:500]))
            rows += [(name, g.name, "skipped", None, None) for g in own]
            continue
        rows.append((name, None, "built", None, None))
        for g in own:
            if missing := sorted(set(g.needs) & held):
                rows.append((name, g.name, "skipped", None, f"needs {', '.join(missing)}"))
                continue
            found = g.rows(tables((name, *g.needs))).count()
            status = "passed" if found <= g.most else "warned" if g.warns else "failed"
            rows.append((name, g.name, status, found, None))
            if status == "failed":
                held.add(name)
    return spark.createDataFrame(rows, "model string, gate string, status string, found long, reason string")
