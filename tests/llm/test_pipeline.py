import re

import corpus_pipeline
from pyspark.sql import functions as F

from shelfmark.llm import mixing, packing, pii, quality, simhash
from shelfmark.llm.queries import END_ID, LENGTH, vocabulary

SF = "/root/testdata/sf0.01"


def test_each_stage_on_its_input(spark, tmp_path):
    """Every stage against its operator on what the stage before kept."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        if number == 4:
            break
        assert out.columns == columns
        out.write.parquet(str(tmp_path / name))
        kept = spark.read.parquet(str(tmp_path / name))
        if name == "quality":
            scored = quality.scores(docs, spark.read.parquet(f"{SF}/labels.parquet"))
            assert kept.count() == scored.filter("predicted = 1").count()
        elif name == "near_duplicates":
            ids, firsts = {r["doc_id"] for r in kept.collect()}, {}
            for r in sorted(docs.collect(), key=lambda r: r["doc_id"]):
                firsts.setdefault(" ".join(r["text"].split()).lower(), r["doc_id"])
            assert ids <= set(firsts.values()) and len(ids) > 0.9 * len(firsts)
            roots = simhash.near_duplicates(docs, shingle=5).collect()
            assert ids <= {r["component_id"] for r in roots}
        elif name == "private_data":
            assert kept.count() == docs.count()
            assert all(not pii.rule_spans(r["text"]) for r in kept.collect())
        elif name == "mixing":
            taken = mixing.mix_plan(docs).agg(F.sum("taken")).first()[0]
            assert kept.agg(F.sum(mixing.words("text"))).first()[0] == taken
        counts.append(kept.count())
        docs = kept
    assert counts[1] < counts[0] and counts[2] <= counts[1] and counts[3] == counts[2]
    pieces = packing.pack_documents(docs, *vocabulary(), LENGTH, END_ID)
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, out.select(*key).collect())) == sorted(map(tuple, pieces.select(*key).collect()))


def test_mixing_stage_is_native(spark):
    plan = corpus_pipeline.mixed(spark, spark.read.parquet(f"{SF}/documents.parquet"), SF)
    assert not re.search("Python|Pandas|Arrow", plan._jdf.queryExecution().executedPlan().toString())
