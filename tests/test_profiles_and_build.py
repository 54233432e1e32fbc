"""Statements with parameters, profiles, the smoke report, and builds with gates."""

import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace.operators import profile, smoke, statements
from millrace.plans import build

ODD = "a `b' \"c.d"


def test_names_and_values_are_never_text(spark):
    rows = spark.createDataFrame([(1, "x"), (2, "it's"), (2, None), (None, "`; DROP")], f"{statements.name(ODD)} long, v string")
    children = spark.createDataFrame([(1,), (1,), (2,), (None,)], f"{statements.name(ODD)} long")
    got = statements.with_counts(rows, children, ODD).collect()
    assert sorted((r["v"] or "", r["n"]) for r in got) == [("", 1), ("`; DROP", 0), ("it's", 1), ("x", 2)]
    assert [r["v"] for r in statements.among(rows, "v", ["it's", "`; DROP", "' OR true --"]).collect()] == ["it's", "`; DROP"]
    assert statements.among(rows, ODD, []).count() == 0 and statements.among(rows, ODD, [2]).count() == 2
    name = "odd_names"
    rows.limit(0).write.mode("overwrite").saveAsTable(name)
    statements.insert(spark, name, [{ODD: 7, "v": "a\\b'c"}, {"v": ":v0_0"}, {ODD: 8}])
    assert sorted(map(tuple, spark.table(name).collect()), key=repr) == sorted([(7, "a\\b'c"), (None, ":v0_0"), (8, None)], key=repr)
    top = statements.grouped_report(spark, name, "v", ODD, 1).collect()
    assert [tuple(r) for r in top] == [(":v0_0", 1, None)]
    with pytest.raises(ValueError):
        statements.run(spark, "SELECT 1; SELECT 2")
    spark.sql(f"DROP TABLE {name}")


def brute_paths(texts):
    out = Counter()

    def walk(path, x):
        kind = {dict: "object", list: "array", str: "string", bool: "boolean", type(None): "null"}.get(type(x), "number")
        if path:
            out[path, kind] += 1
        if isinstance(x, dict):
            for k, v in x.items():
                step = json.dumps(k, ensure_ascii=False) if any(c in k for c in '.[]"') else k
                walk(f"{path}.{step}" if path else step, v)
        if isinstance(x, list):
            for v in x:
                walk(f"{path}[]", v)

    for t in texts:
        try:
            walk("", json.loads(t))
        except (ValueError, TypeError):
            pass
    return dict(out)


def test_paths_are_found(spark):
    texts = [
        '{"a": 1, "b": {"c": [1, "x", null, {"d": true}], "e.f": 2.5}}', '{"a": "s", "b": [], "q\\"t": {}}', "[1, [2, [3]]]", '"text"', "5", "{bad", "", None, '{"a": null}', '{"é": {"é": 1e3, "é.漢": 1}}',
    ]
    got = profile.paths(spark.createDataFrame([(t,) for t in texts], "raw string"), "raw").collect()
    assert {(r["path"], r["kind"]): r["n"] for r in got} == brute_paths(texts)


def test_summaries_hold_their_bounds(spark):
    rng = random.Random(2)
    keys = [f"k{int(rng.paretovariate(0.8)) % 4000}" for _ in range(20_000)] + [None] * 50
    df = spark.createDataFrame([(k,) for k in keys], "k string").repartition(7)
    exact = Counter(k for k in keys if k is not None)
    total = sum(exact.values())
    for most in (10, 100, 100_000):
        found = {r["value"]: r for r in profile.frequent(df, "k", most).collect()}
        for k, r in found.items():
            assert r["rows"] == total and r["at_least"] <= exact[k] <= r["at_most"] and (r["at_most"] - r["at_least"]) * (most + 1) <= total
        assert all(k in found for k, n in exact.items() if n * (most + 1) > total)
        assert len(found) <= 7 * most
    assert all(r["at_least"] == r["at_most"] == exact[k] for k, r in found.items()) and len(found) == len(exact)
    assert profile.frequent(df.where("false"), "k").count() == 0


def test_keys_dealt_by_weight(spark):
    rows = [(f"k{i}",) for i, n in enumerate([40, 30, 20, 10, 10, 10]) for _ in range(n)]
    got = {r["n"]: r for r in profile.dealt(spark.createDataFrame(rows, "k string"), "k", (1, 2, 3)).collect()}
    assert got[1]["weighted_share"] == 1 and got[2]["weighted_share"] == 0.5 and got[3]["weighted_share"] == round(40 / 120, 4)
    assert all(r["weighted_share"] <= r["crc32_share"] and r["floor"] == round(40 / 120, 4) for r in got.values())


def test_smoke(spark):
    def of(*texts):
        df = spark.createDataFrame([(t,) for t in texts], "raw_payload string")
        return {r["check"]: (r["level"], r["found"]) for r in smoke.report(df, "$.meta.domain", {"id": "$.meta.id", "domain": "$.meta.domain"}, ["meta", "type"]).collect()}

    good = '{"meta": {"id": "a", "domain": "d"}, "type": "edit"}'
    assert set(of(good, good).values()) == {("ok", 0)}
    assert of(good, "[1]", "{no", "", None)["decodable"] == ("warn", 4)
    got = of(good, '{"meta": {"id": " "}, "type": "x", "new": 1}')
    assert got == {"decodable": ("ok", 0), "keyable": ("bad", 1), "complete": ("bad", 2), "contract": ("bad", 1)}
    assert of('{"meta": {"id": "a", "domain": "d"}}')["contract"] == ("bad", 1)
    assert of() == {"decodable": ("warn", 0), "keyable": ("ok", 0), "complete": ("ok", 0), "contract": ("ok", 0)}


def models(spark, built):
    def m(name, *needs, fails=False):
        def make(tables):
            built.append(name)
            assert set(tables) == set(needs)
            if fails:
                raise RuntimeError("broken")
            return spark.range(len(name) if not needs else sum(t.count() for t in tables.values()))

        return build.Model(name, make, needs)

    return m


def test_a_failing_gate_stops_exactly_its_descendants(spark, tmp_path):
    built = []
    m = models(spark, built)
    graph = [m("d", "b", "c"), m("b", "a"), m("a"), m("c", "a"), m("e", "c"), m("lone")]
    gates = [
        build.Gate("b_empty", "b", lambda t: t["b"]), build.Gate("a_some", "a", lambda t: t["a"].where("id > 5")), build.Gate("d_fine", "d", lambda t: t["d"]),
        build.Gate("c_small", "c", lambda t: t["c"], warns=True), build.Gate("e_of_b", "e", lambda t: t["b"], ("b",)),
    ]
    rows = {(r["model"], r["gate"]): (r["status"], r["found"]) for r in build.run(spark, str(tmp_path), graph, gates).collect()}
    assert rows["b", None] == ("built", None) and rows["b", "b_empty"] == ("failed", 1) and rows["d", None] == ("skipped", None) and rows["d", "d_fine"][0] == "skipped"
    assert rows["c", "c_small"] == ("warned", 1) and rows["e", None][0] == "built" and rows["e", "e_of_b"][0] == "skipped" and rows["a", "a_some"] == ("passed", 0)
    assert sorted(built) == ["a", "b", "c", "e", "lone"] and built.index("a") < min(built.index("b"), built.index("c"))


def test_a_broken_model_and_selection(spark, tmp_path):
    built = []
    m = models(spark, built)
    graph = [m("a"), m("b", "a", fails=True), m("c", "b"), m("d", "a")]
    rows = {r["model"]: (r["status"], r["reason"]) for r in build.run(spark, str(tmp_path), graph, []).collect()}
    assert rows["b"][0] == "failed" and "broken" in rows["b"][1] and rows["c"] == ("skipped", "needs b") and rows["d"][0] == "built"
    assert build.selected(graph, ["+c"]) == {"a", "b", "c"} and build.selected(graph, ["b+"]) == {"b", "c"} and build.selected(graph, ["d"]) == {"d"}
    built.clear()
    build.run(spark, str(tmp_path), graph, [], ["d"])  # a is read as it was written before
    assert built == ["d"]
    for wrong in ([build.Model("x", None, ("y",))], [build.Model("x", None, ("y",)), build.Model("y", None, ("x",))], [m("a"), m("a")]):
        with pytest.raises(ValueError):
            build.ordered(wrong, [])
