import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from shelfmark.llm import rans, token_files

PATH = public_tokenizers.path("word_bpe_49k.json")
SF = "/root/testdata/sf0.01"


@given(st.lists(st.integers(0, 300), max_size=700), st.integers(0, 1 << 40))
@settings(max_examples=60, deadline=None)
def test_any_ids_come_back(numbers, before):
    ids = np.array(numbers, dtype=np.uint32)
    table = rans.Table.of_counts(*np.unique(ids, return_counts=True))
    data = rans.encode_block(ids, table, [None, 7], [len(ids) // 2, len(ids) - len(ids) // 2], before)
    block = rans.Block(data)
    assert np.array_equal(block.ids(rans.Table.from_bytes(table.to_bytes())), ids)
    assert (block.doc_ids, block.before, block.lengths.sum()) == ([None, 7], before, len(ids))


def skewed(count, seed=0):
    rng = np.random.default_rng(seed)
    return np.minimum(rng.zipf(1.3, count), 60_000).astype(np.uint32)


def test_long_blocks_segments_and_size(monkeypatch):
    ids = skewed(300_001)
    table = rans.Table.of_counts(*np.unique(ids, return_counts=True))
    block = rans.Block(rans.encode_block(ids, table, [1], [len(ids)]))
    assert block.checkpoints == 3 and np.array_equal(block.ids(table), ids)
    # Decoding may begin at any checkpoint.
    step = block.every * block.lanes
    assert np.array_equal(block.segment(2, table), ids[2 * step:])
    assert np.array_equal(block.segment(1, table), ids[step:2 * step])
    share = np.unique(ids, return_counts=True)[1] / len(ids)
    assert block.size < len(ids) / 8 * -(share * np.log2(share)).sum() * 1.1 + 20_000


def test_rare_ids_keep_a_frequency_and_one_id_is_fine():
    table = rans.Table.of_counts(range(50_000), [10**15] + [1] * 49_999)
    assert int(table.frequencies.sum()) == 1 << table.bits and table.frequencies.min() == 1
    ids = np.array([0, 49_999, 7, 7, 0] * 40, dtype=np.uint32)
    assert np.array_equal(rans.Block(rans.encode_block(ids, table, [1], [200])).ids(table), ids)
    one = rans.Table.of_counts([5], [9])
    ids = np.full(1000, 5, dtype=np.uint32)
    assert np.array_equal(rans.Block(rans.encode_block(ids, one, [1], [1000])).ids(one), ids)
    with pytest.raises(ValueError):
        rans.encode_block(np.array([6], dtype=np.uint32), one, [1], [1])
    with pytest.raises(ValueError):
        rans.encode_block(np.array([4], dtype=np.uint32), one, [1], [1])


def test_large_ids_are_searched_for_and_small_ones_looked_up():
    for last in (70, rans.LISTED + 5):
        table = rans.Table.of_counts([3, 9, 40, last], [1, 2, 3, 4])
        assert table.symbols(np.array([40, 3, last, 9, 3], dtype=np.uint32)).tolist() == [2, 0, 3, 1, 0]
        assert table.symbols(np.zeros(0, dtype=np.uint32)).tolist() == []
        for other in (0, 8, 41, last - 1, last + 1):
            with pytest.raises(ValueError):
                table.symbols(np.array([3, other], dtype=np.uint32))
    with pytest.raises(ValueError):
        rans.Table.of_counts([], []).symbols(np.array([0], dtype=np.uint32))


def test_damage_is_noticed():
    ids = skewed(5000)
    table = rans.Table.of_counts(*np.unique(ids, return_counts=True))
    data = rans.encode_block(ids, table, [1, 2], [2000, 3000])
    for at in range(0, len(data), 7):
        broken = bytearray(data)
        broken[at] ^= 64
        with pytest.raises(rans.Damaged):
            rans.Block(bytes(broken)).ids(table)
    with pytest.raises(rans.Damaged):
        rans.Block(data[:-1])
    with pytest.raises(rans.Damaged):
        list(rans.blocks(data + b"?", b"\n"))
    other = rans.Table.of_counts(range(60_001), [1] * 60_001)
    with pytest.raises(rans.Damaged):
        rans.Block(data).ids(other)
    with pytest.raises(rans.Damaged):
        rans.Table.from_bytes(table.to_bytes()[:-4] + b"abcd")


TOKENIZER = Tokenizer.from_file(PATH)


def whole(text):
    ids = TOKENIZER.encode(text or "", add_special_tokens=False).ids + [2]
    return np.array(ids, dtype="<u4").tobytes()


@given(st.text(st.sampled_from("aB'sré \t\n\x0b\x0c\r\x1c\x85\xa0 ́　<|endoftext|>#9漢\U0001F600İß가"), max_size=60))
@settings(max_examples=300, deadline=None)
def test_word_by_word_is_the_whole_text(text):
    assert words.encode(text).tobytes() + b"\x02\0\0\0" == whole(text)


words = token_files.Words(PATH)


def test_words_are_forgotten_when_there_are_too_many(monkeypatch):
    monkeypatch.setattr(token_files, "KEPT_WORDS", 3)
    few = token_files.Words(PATH)
    for text in ("one two three four five", "five " + "x" * 200, "one two", ""):
        assert few.encode(text).tobytes() + b"\x02\0\0\0" == whole(text)


@given(st.text(st.sampled_from("aBÉsß '\"!#$%&()*+,-./:;<=>?@[\\]^_`{|}~9\x1c\x85\xa0\u0301\u0338"), max_size=40))
@settings(max_examples=200, deadline=None)
def test_signs_after_letters_are_the_whole_text(text):
    assert words.encode(text).tobytes() + b"\x02\0\0\0" == whole(text)
    for c in map(chr, range(33, 127)):
        assert words.encode(f"Été{c} x{c}{c}").tobytes() + b"\x02\0\0\0" == whole(f"Été{c} x{c}{c}")


def test_case_and_signs_ask_the_model_once():
    few, asked = token_files.Words(PATH), []
    model = few._model

    class Asked:
        def tokenize(self, word):
            asked.append(word)
            return model.tokenize(word)

    few._model = Asked()
    text = "River river RIVER river*** river, River$$$ river***"
    assert few.encode(text).tobytes() + b"\x02\0\0\0" == whole(text) and asked == ["river"]


def check(spark, docs, path, **how):
    token_files.write_tokens(docs, path, PATH, 2, **how)
    got = sorted(token_files.read_tokens(spark, path).collect(), key=lambda r: r["start"])
    rows = docs.select("doc_id", "text").collect()
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0, bytes(r["ids"])) for r in got) == \
        sorted((r["doc_id"] is not None, r["doc_id"] or 0, whole(r["text"])) for r in rows)
    at = 0
    for r in got:
        assert r["start"] == at
        at += len(r["ids"]) // 4
    order = [(r["doc_id"] is not None, r["doc_id"] or 0) for r in got]
    assert order == sorted(order)
    return got


def test_awkward_rows(spark, awkward, nothing, tmp_path):
    check(spark, awkward, f"{tmp_path}/a", block_ids=500)
    check(spark, awkward, f"{tmp_path}/b")
    assert check(spark, nothing, f"{tmp_path}/c") == []


def test_files_are_in_order_and_small(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCKS_PER_FILE", 2)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    check(spark, docs, f"{tmp_path}/t", block_ids=5000)
    table = token_files.read_table(spark, f"{tmp_path}/t")
    before = []
    for file in sorted((tmp_path / "t" / "blocks").glob("part-*")):
        found = list(rans.blocks(file.read_bytes(), token_files.PARTED))
        assert 1 <= len(found) <= 2
        before += [b.before for b in found]
    assert before == sorted(before) and len(before) > 50 and len(table.ids) > 1000


def test_repeated_and_null_ids_spread(spark, tmp_path):
    docs = spark.range(4000).selectExpr("IF(id % 2 = 0, NULL, 5L) AS doc_id", "concat('same words ', id % 3) AS text")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")    # small parts are kept apart
    try:
        token_files.write_tokens(docs, str(tmp_path / "h"), PATH, 2)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    # A third of the rows and more under one id, yet every task wrote its part.
    assert len(list((tmp_path / "h" / "blocks").glob("part-*"))) >= 6
    assert token_files.read_tokens(spark, str(tmp_path / "h")).count() == 4000


def test_damaged_files_fail(spark, tmp_path):
    docs = spark.createDataFrame([(1, "some words to keep")], "doc_id long, text string")
    token_files.write_tokens(docs, str(tmp_path / "d"), PATH, 2)
    file, = [f for f in (tmp_path / "d" / "blocks").glob("part-*") if f.stat().st_size]
    data = bytearray(file.read_bytes())
    data[-3] ^= 1
    (tmp_path / "d" / "blocks" / f".{file.name}.crc").unlink()
    file.write_bytes(bytes(data))
    with pytest.raises(Exception, match="not what was written"):
        token_files.read_tokens(spark, str(tmp_path / "d")).collect()


def test_crc_of_the_bytes_is_that_of_the_ids(spark, tmp_path):
    docs = spark.createDataFrame([(1, "some words to keep")], "doc_id long, text string")
    token_files.write_tokens(docs, str(tmp_path / "e"), PATH, 2)
    row = token_files.read_tokens(spark, str(tmp_path / "e")).selectExpr("crc32(ids) AS crc").first()
    assert row["crc"] == zlib.crc32(whole("some words to keep"))
