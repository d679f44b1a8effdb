import re
from collections import defaultdict

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelfmark.llm import mixing
from shelfmark.llm.queries import SQL


def water_fill(sizes, weights, share, most):
    """Targets by the rule itself: share out, stop those above, share the excess again."""
    total = share * sum(sizes.values())
    stopped, level = {}, {}
    while True:
        open_ = [s for s in sizes if s not in stopped]
        weight = sum(weights[s] for s in open_)
        level = {s: (total - sum(stopped.values())) * weights[s] / weight for s in open_} if open_ else {}
        above = [s for s in open_ if level[s] > most * sizes[s] + 1e-9]
        if not above:
            return stopped | level
        stopped |= {s: most * sizes[s] for s in above}


def test_targets_and_taken_words(awkward):
    rows = awkward.select("doc_id", "text", "source").collect()
    sizes = defaultdict(int)
    for r in rows:
        sizes[r["source"]] += len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))
    ordered = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    want = water_fill(dict(sizes), {s: (5, 2, 1)[i % 3] for i, s in enumerate(ordered)}, 1.5, 2.0)
    got = mixing.mix_plan(awkward).collect()
    assert len(got) == len(rows)
    assert sum(want.values()) == pytest.approx(1.5 * sum(sizes.values()))
    by_target = defaultdict(list)
    for r in got:
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        by_target[r["source_size"]].append(r)
    for source, size in sizes.items():
        own = by_target[size]
        assert own[0]["target"] == pytest.approx(want[source])
        assert abs(sum(r["taken"] for r in own) - want[source]) <= max(r["size"] for r in own) / 2 + 1e-6


def test_reruns_and_other_partitions_agree(awkward):
    key = ["doc_id", "size", "taken"]
    first = sorted(map(repr, mixing.mix_plan(awkward).select(*key).collect()))
    assert first == sorted(map(repr, mixing.mix_plan(awkward.repartition(3, "source")).select(*key).collect()))


def test_mix_repeats_rows_in_their_columns(awkward):
    plan = mixing.mix_plan(awkward)
    mixed = mixing.mix(awkward)
    assert mixed.columns == awkward.columns
    words = mixed.agg(F.sum(mixing.words("text"))).first()[0]
    assert words == plan.agg(F.sum("taken")).first()[0]


def test_empty_and_wordless_tables(spark, nothing):
    assert mixing.mix_plan(nothing).count() == 0
    blank = spark.createDataFrame([(1, None, "a"), (2, " ", "a")], "doc_id long, text string, source string")
    assert [(r["size"], r["target"], r["taken"]) for r in mixing.mix_plan(blank).collect()] == [(0, 0.0, 0)] * 2


def test_repeated_rows_come_near_their_target(spark, monkeypatch):
    """A source that is one row many times over, NULL ids among them, beside ordinary ones."""
    monkeypatch.setattr(mixing, "RUN_BITS", 4)
    rows = ([(None, "three words here", "a")] * 900 + [(7, "two words", None)] * 500
            + [(k, "w " * (k % 9), "b") for k in range(400)])
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    plan = mixing.mix_plan(docs)
    got = plan.collect()
    assert len(got) == len(rows)
    for source_size, most in ((2700, 3), (1000, 2), (sum(k % 9 for k in range(400)), 8)):
        own = [r for r in got if r["source_size"] == source_size]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= most / 2 + 1e-6
        assert all(r["taken"] <= 2 * r["size"] for r in own)
    parts = [r for r in got if r["doc_id"] is None]
    assert {r["copies"] for r in parts} == {1, 2} or {r["copies"] for r in parts} == {0, 1}
    key = ["doc_id", "size", "taken"]
    again = mixing.mix_plan(docs.repartition(11)).select(*key).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, plan.select(*key).collect()))
    mixed = mixing.mix(docs.withColumn("_mix_place", F.lit("x")).withColumn("_mix_taken", F.lit(9)))
    assert mixed.columns == ["doc_id", "text", "source", "_mix_place", "_mix_taken"]
    assert mixed.agg(F.sum(mixing.words("text"))).first()[0] == sum(r["taken"] for r in got)
    with duckdb.connect() as db:
        db.register("documents", pd.DataFrame({"doc_id": pd.array([r[0] for r in rows], "Int64"),
                                               "text": [r[1] for r in rows], "source": [r[2] for r in rows]}))
        by_sql = db.sql(SQL["op8_mixing"]).select("doc_id, size, taken").fetchall()
    assert sorted(map(repr, by_sql)) == sorted(repr((r["doc_id"], r["size"], r["taken"])) for r in got)
    assert mixed.count() == sum(r["copies"] for r in got)


def test_no_python_in_the_plan(awkward):
    plan = mixing.mix_plan(awkward)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
