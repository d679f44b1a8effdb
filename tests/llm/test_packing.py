import zlib

import numpy as np
import pytest

from shelfmark.llm import packing
from shelfmark.llm.queries import END_ID, vocabulary

tokenizers = pytest.importorskip("tokenizers")
public = pytest.importorskip("public_tokenizers")


def ids_of(text):
    tokenizer = tokenizers.Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [END_ID]


def test_pieces_hold_the_tokenizer_ids(awkward):
    length = 64
    packed = packing.pack_documents(awkward, *vocabulary(), length, END_ID).collect()
    got = sorted((r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in packed)
    want = []
    for row in awkward.collect():
        ids = ids_of(row["text"])
        for piece, (start, count) in enumerate(packing.cut(len(ids), length)):
            raw = np.array(ids[start:start + count], "<u4").tobytes()
            want.append((piece, start, count, zlib.crc32(raw)))
    assert got == sorted(want)
    sequences = {}
    for r in packed:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for members in sequences.values():
        at = 0
        for offset, count in sorted(members):
            assert offset == at
            at += count
        assert at <= length
    assert len(sequences) <= sum(w[2] for w in want) / length * 1.02 + 2


def test_odd_white_space_and_special_strings():
    encoding = packing._encoding(*vocabulary())
    for text in ("", " ", "  a  b", "a\n \nb", "it's  \t x\n\n\ny ", "a <|endoftext|> b", "x \x85 y", "​ a"):
        assert encoding.encode_to_numpy(text, disallowed_special=()).tolist() + [END_ID] == ids_of(text)


def test_ids_are_those_of_the_file_as_it_is(spark):
    """Against the tokenizers file with no switch but add_special_tokens=False."""
    tokenizer = tokenizers.Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    long = packing.LONG_RUN
    texts = ["a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|> x", "<|endoftext", "<|<|endoftext|>|>",
             "two\n\n<|endoftext|>\n y"]
    texts += [f"a{gap * n}{after}" for gap in (" ", "\t", "\n") for n in (long - 1, long, 1_000_000)
              for after in ("", "b", "'s", "<|endoftext|>", "\u3000", " \x1c")]
    texts += [" " * 1_000_000, "x" + " \u3000\r" * 400_000 + "y" + "\n" * long + "z<|endoftext|>" + " " * long]
    encoding = packing._encoding(*vocabulary())
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert want[0] == [64, 220, 50256, 275]
    for text, ids in zip(texts, want):
        assert packing.token_ids(encoding, text).tolist() == ids
    few = [0, 2, 5, 12, len(texts) - 1]
    docs = spark.createDataFrame([(k, texts[k]) for k in few], "doc_id long, text string")
    sizes = packing.pack_documents(docs, *vocabulary(), 1024, END_ID).groupBy("doc_id").sum("length").collect()
    got = {r["doc_id"]: r["sum(length)"] for r in sizes}
    assert got == {k: len(want[k]) + 1 for k in few}


def test_cut():
    assert packing.cut(5, 4) == [(0, 1), (1, 4)]
    assert packing.cut(8, 4) == [(0, 4), (4, 4)]
    assert packing.cut(3, 4) == [(0, 3)]


def squares(bins, lengths):
    return sum(int(lengths[b].sum()) ** 2 for b in bins)


@pytest.mark.parametrize("start", ["alone", "pairs", "best_fit"])
def test_swap_search_only_improves(start):
    rng = np.random.default_rng(0)
    lengths = rng.integers(1, 60, 120)
    bins = {"alone": [[i] for i in range(120)], "pairs": [[i, i + 1] for i in range(0, 120, 2)],
            "best_fit": packing.best_fit(lengths, 128)}[start]
    before, count = squares(bins, lengths), len(bins)
    after = packing.swap_search([list(b) for b in bins], lengths, 128)
    assert sorted(i for b in after for i in b) == list(range(120))
    assert all(lengths[b].sum() <= 128 for b in after)
    assert len(after) <= count and squares(after, lengths) >= before
    if start != "best_fit":
        assert len(after) < count


def test_exchanges_empty_a_bin():
    # 6 + 4 and 7 + 3 leave 5 + 5 one bin that only exchanges of one and two for one can fill.
    lengths = np.array([6, 3, 7, 2, 1, 1])
    after = packing.swap_search([[0, 1], [2, 3], [4, 5]], lengths, 10)
    assert len(after) == 2


def test_every_underfull_bin_gives():
    # None of the emptier bins can give its 6; the last bin's threes go to three of them.
    lengths = np.array([6] * 150 + [3, 3, 3])
    after = packing.swap_search([[i] for i in range(150)] + [[150, 151, 152]], lengths, 10)
    assert len(after) == 150 and all(lengths[b].sum() <= 10 for b in after)


def test_empty_table(nothing):
    assert packing.pack_documents(nothing, *vocabulary(), 16).count() == 0
