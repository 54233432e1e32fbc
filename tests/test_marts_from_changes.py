"""Sketch marts and marts kept from changes, against exact results and full rebuilds."""

import contextlib
import datetime as dt
import io
import random

import pytest
from pyspark.sql import functions as F

from millrace.plans import delta, sketches

T0 = dt.datetime(2024, 1, 1)


def plan(df):
    with contextlib.redirect_stdout(io.StringIO()) as out:
        df.explain("formatted")
    return out.getvalue()


def stg(spark, rows):
    return spark.createDataFrame(
        rows, "event_minute timestamp, wiki string, is_bot boolean, editor string, page_title string, bytes_delta long, late_by_seconds long, is_canary boolean, ingested_at timestamp"
    )


@pytest.fixture(scope="module")
def skewed(spark):
    """An hour with nearly all rows and one with few; lags with a long tail."""
    r = F.rand(5)
    minute = F.timestamp_add("minute", F.when(r < 0.97, F.floor(r * 60)).otherwise(60 + F.floor(r * 60)).cast("int"), F.lit(T0))
    return spark.range(60_000).select(
        minute.alias("event_minute"), F.lit("w").alias("wiki"), (F.col("id") % 3 == 0).alias("is_bot"), F.concat(F.lit("e"), F.col("id") % 40_000).alias("editor"),
        F.concat(F.lit("p"), F.col("id") % 20_011).alias("page_title"), (F.col("id") % 5).alias("bytes_delta"), F.floor(F.pow(F.rand(7), 6) * 100_000).alias("late_by_seconds"),
        F.lit(False).alias("is_canary"), F.lit(T0).alias("ingested_at"),
    ).persist()


def test_merged_percentiles_are_within_the_rank_bound(spark, skewed):
    state = sketches.edits_state(skewed, None, T0 + dt.timedelta(days=1))
    found = sketches.late_percentiles(state).select("event_hour", "p", "value")
    rows = skewed.withColumn("event_hour", F.date_trunc("hour", "event_minute"))
    judged = sketches.rank_check(found, rows, ["event_hour"], "late_by_seconds").collect()
    assert len(judged) == 6 and all(r["within"] for r in judged)
    # the verdict can be false: values that are off by more than the bound
    off = found.withColumn("value", F.col("value") * 4 + 100)
    assert not any(r["within"] for r in sketches.rank_check(off.where("p < 0.9"), rows, ["event_hour"], "late_by_seconds").collect())


def test_merged_distinct_counts(spark, skewed):
    state = sketches.edits_state(skewed, None, T0 + dt.timedelta(days=1)).persist()
    exact = skewed.groupBy(F.date_trunc("hour", "event_minute").alias("event_hour")).agg(
        F.countDistinct(F.when(F.col("is_bot"), F.col("editor"))).alias("b"), F.countDistinct(F.when(~F.col("is_bot"), F.col("editor"))).alias("h"), F.countDistinct("page_title").alias("p")
    )
    both = sketches.bot_vs_human(state).join(exact, "event_hour").collect()
    for r in both:
        for got, want in ((r["bot_editors"], r["b"]), (r["human_editors"], r["h"]), (r["pages"], r["p"])):
            assert abs(got - want) <= sketches.COUNT_ERROR * want + 0.5
    assert max(r["p"] for r in both) > 15_000 and any(r["pages"] != r["p"] for r in both)  # an estimate, over minutes
    # a union of a state with itself counts nobody twice
    twice = sketches.distinct_counts(state.select("wiki", "pages").unionByName(state.select("wiki", "pages")), ["wiki"], ["pages"]).first()["pages"]
    assert twice == sketches.distinct_counts(state.select("wiki", "pages"), ["wiki"], ["pages"]).first()["pages"]
    assert not spark.range(1).select(sketches.within_count(F.lit(110), F.lit(100))).first()[0]


def test_a_state_of_late_rows_is_added_and_raw_rows_are_not_read(spark, tmp_path):
    def row(minute, editor, bot, at):
        return (T0 + dt.timedelta(minutes=minute), "w", bot, editor, "p", 1, 5, False, T0 + dt.timedelta(hours=at))

    rows = stg(spark, [row(1, "a", False, 1), row(2, "a", True, 1), row(61, None, False, 2), row(2, "b", False, 9), row(3, "a", False, 9)])
    cut = T0 + dt.timedelta(hours=5)
    path = str(tmp_path / "state")
    sketches.edits_state(rows, None, cut).write.parquet(path)
    sketches.edits_state(rows, cut, cut + dt.timedelta(days=1)).write.mode("append").parquet(path)
    mart = sketches.bot_vs_human(spark.read.parquet(path))
    got = {r["event_hour"].hour: r for r in mart.collect()}
    assert (got[0]["events"], got[0]["human_editors"], got[0]["bot_editors"], got[0]["editors_on_both_sides"]) == (4, 2, 1, 1)
    assert (got[1]["events"], got[1]["human_editors"]) == (1, 0)
    p = plan(sketches.bot_vs_human(spark.read.parquet(path)))
    assert p.count("\nLocation: ") == 1 and "Expand" not in p


VIEW = delta.View(("k", "g"), {"total": "x"}, {"names": "name"}, {"low": "x"}, {"high": "x", "last": "name"})


def groups(df):
    return sorted((tuple(r) for r in df.select("k", "g", "rows", "total", "names", "low", "high", "last").collect()), key=repr)


def test_changes_agree_with_a_full_rebuild(spark):
    rng = random.Random(11)

    def frame(rows):
        return spark.createDataFrame(rows, "id long, k long, g string, x long, name string").drop("id").persist()

    def some(n, at):
        return [(at + i, rng.choice([None, 1, 2, 3]), rng.choice(["a", "b", None]), rng.choice([None, 1, 2, 3, 50]), rng.choice(["u", "v", "w", None])) for i in range(n)]

    have = some(60, 0)
    state = delta.full(frame(have), VIEW)
    for turn in range(3):
        went = rng.sample(have, 25)
        if turn == 1:  # whole groups go
            went = [r for r in have if r[1] == 2]
        came = some(12, 1000 * (turn + 1))
        ids = {r[0] for r in went}
        have = [r for r in have if r[0] not in ids] + came
        base = frame(have)
        change = delta.apply(state, VIEW, frame(came), frame(went), base)
        state = delta.merged(state, change, VIEW)
        state = delta.State(state.groups.persist(), {n: v.persist() for n, v in state.values.items()})
        full = delta.full(base, VIEW)
        assert groups(state.groups) == groups(full.groups)
        assert sorted(map(tuple, state.values["names"].select("k", "g", "value", "n").collect()), key=repr) == sorted(map(tuple, full.values["names"].select("k", "g", "value", "n").collect()), key=repr)


def test_the_base_is_read_for_lost_witnesses_only(spark, tmp_path):
    def stored(name, rows):
        spark.createDataFrame(rows, "k long, g string, x long, name string").write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    old = [(1, "a", 5, "u"), (1, "a", 9, "v"), (2, "a", 1, "u"), (2, "a", 2, "u"), (3, "b", 4, "w")]
    before = stored("before", old)
    came, went = stored("came", [(2, "a", 0, "z")]), stored("went", [(2, "a", 1, "u"), (1, "a", 9, "v"), (3, "b", 4, "w")])
    base = stored("base_rows", [(1, "a", 5, "u"), (2, "a", 2, "u"), (2, "a", 0, "z")])
    state = delta.full(before, VIEW)
    only_came = delta.apply(state, VIEW, came, None, base)
    assert "base_rows" not in plan(only_came.changed.groups) and only_came.lost.count() == 0
    change = delta.apply(state, VIEW, came, went, base)
    assert [tuple(r) for r in change.lost.collect()] == [(1, "a")]  # (2, a): what came is smaller than what went
    assert "LeftSemi" in plan(change.changed.groups) and [tuple(r) for r in change.gone.collect()] == [(3, "b")]
    assert groups(change.changed.groups) == [(1, "a", 1, 5, 1, 5, 5, "u"), (2, "a", 2, 2, 2, 0, 2, "z")]


def test_top_rows_of_a_bucket_that_shrinks(spark):
    view = delta.View(("h", "p"))

    def frame(rows):
        return spark.createDataFrame(rows, "h long, p string").persist()

    before = [(1, "a")] * 3 + [(1, "b")] * 2 + [(1, "c")] + [(2, "a")]
    state = delta.full(frame(before), view)
    change = delta.apply(state, view, frame([(1, "c")] * 3), frame([(1, "a")] * 3 + [(2, "a")]), frame([]))
    after = delta.merged(state, change, view).groups
    top = delta.top_changed(after, change, ("h",), [F.desc("rows"), F.asc("p")], 1)
    assert [tuple(r) for r in top.select("h", "p", "rows").collect()] == [(1, "c", 4)]


def test_a_stored_state_is_updated_part_by_part(spark, tmp_path):
    def frame(name, rows):
        spark.createDataFrame(rows, "k long, g string, x long, name string").write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    def files():
        return {str(f.relative_to(tmp_path / "s")) for f in (tmp_path / "s").glob("*-0/*/part-*")} | {str(f.relative_to(tmp_path / "s")) for f in (tmp_path / "s").glob("groups/*/part-*")}

    root, part = str(tmp_path / "s"), "k % 10"
    old = [(1, "a", 5, "u"), (11, "a", 9, "v"), (2, "a", 1, "u"), (3, "b", 4, "w"), (None, "b", 4, "w")]
    delta.store(delta.full(frame("old", old), VIEW), VIEW, root, part)
    before = files()
    came, went = [(1, "a", 2, "z"), (None, "b", 7, "q")], [(11, "a", 9, "v"), (3, "b", 4, "w")]
    after = frame("after", [r for r in old if r not in went] + came)
    delta.update(spark, VIEW, root, part, frame("came", came), frame("went", went), after)
    assert groups(delta.stored(spark, VIEW, root).groups) == groups(delta.full(after, VIEW).groups)
    changed = {f.split("/")[1] for f in before ^ files()}
    assert changed == {"part=p1", "part=p3", "part=none"}  # not p2
    delta.finish(spark, VIEW, root)  # again: nothing changes
    assert groups(delta.stored(spark, VIEW, root).groups) == groups(delta.full(after, VIEW).groups)
    values = delta.stored(spark, VIEW, root).values["names"]
    assert sorted(map(tuple, values.select("k", "g", "value", "n").collect()), key=repr) == sorted(map(tuple, delta.full(after, VIEW).values["names"].select("k", "g", "value", "n").collect()), key=repr)
