import zlib

from shelfmark.llm import sharding


def sizes(awkward):
    return [len((r["text"] or "").encode()) + 8 for r in awkward.collect()]


def test_contiguous_and_balanced(awkward):
    got = sharding.cut_shards(awkward, 5).collect()
    assert sorted(r["size"] for r in got) == sorted(sizes(awkward))
    ordered = sorted(got, key=lambda r: (r["shard"], r["slot"]))
    ids = [r["doc_id"] for r in ordered]
    assert ids == sorted(ids, key=lambda i: (i is not None, i))
    total, largest = sum(r["size"] for r in got), max(r["size"] for r in got)
    for shard in range(5):
        own = [r for r in ordered if r["shard"] == shard]
        assert [r["slot"] for r in own] == list(range(len(own)))
        assert abs(sum(r["size"] for r in own) - total / 5) <= largest
    texts = sorted(zlib.crc32((r["text"] or "").encode()) for r in awkward.collect())
    assert sorted(r["text_crc32"] for r in got) == texts


def test_equal_rows_are_split(spark):
    same = spark.createDataFrame([(1, "x" * 92)] * 300, "doc_id long, text string")
    counts = sharding.cut_shards(same, 3).groupBy("shard").count().collect()
    assert sorted(r["count"] for r in counts) == [100, 100, 100]


def test_empty_table_and_more_shards_than_rows(spark, nothing):
    assert sharding.cut_shards(nothing, 4).count() == 0
    few = spark.createDataFrame([(2, "b"), (1, None)], "doc_id long, text string")
    assert [r["doc_id"] for r in sharding.cut_shards(few, 9).orderBy("shard").collect()] == [1, 2]


def test_written_shards_hold_all_columns(spark, awkward, tmp_path):
    sharding.write_shards(awkward, str(tmp_path / "out"), 3)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.drop("_shard").columns == awkward.columns
    assert back.drop("_shard").exceptAll(awkward).isEmpty() and back.count() == awkward.count()
