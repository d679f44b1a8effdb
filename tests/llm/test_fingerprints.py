import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from shelfmark.llm import fingerprints

BLANK = " \t\n\x0b\f\r"


def cut(line, least, most, sentences):
    """Where the piece at the start of a line ends: after a sentence, else a word, else as late as it may."""
    if len(line) < least:
        return len(line)
    ends = [k for k in range(least, min(most, len(line)) + 1)]
    for k in ends if sentences else []:
        if line[k - 1] in ".!?" and line[k:k + 1] and line[k] in BLANK:
            return k
    for k in ends:
        if line[k:k + 1] and line[k] in BLANK:
            return k
    return min(most, len(line))


def paragraphs(text):
    """Character by character: the first piece of a text is short, later ones have 160 to 320 characters."""
    body = text.lstrip("\n")
    found, breaks = set(), text[:len(text) - len(body)]
    for number, line in enumerate(body.split("\n")):
        # A line break is a blank to the line before it.
        rest, more = line, number < body.count("\n")
        while rest:
            end = cut(rest + "\n" * more, *((16, 48, False) if breaks is not None else (160, 320, True)))
            end = min(end, len(rest))
            found.add((breaks or "") + rest[:end])
            rest, breaks = rest[end:], None
    return found


def test_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = sorted(docs.select("doc_id", "text").collect(), key=lambda r: -r["doc_id"])
    got = {r["doc_id"]: r for r in fingerprints.fingerprint_versions(docs).collect()}
    assert len(got) == len(rows)
    for this, following in zip(rows, rows[1:] + rows[:1]):
        text, other, row = this["text"], following["text"], got[this["doc_id"]]
        half = len(text) // 2
        edited = text[:len(text) - half] + other[:half]
        assert row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        for name, version in (("near_edited", edited), ("near_next", other)):
            a, b = paragraphs(text), paragraphs(version)
            assert row[name] == pytest.approx(len(a & b) / max(1, len(a | b)))


def test_texts_with_an_equal_half_share_a_paragraph(spark):
    """Every text over 100 characters is like its edited version, lines without sentences and scripts without blanks too."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    odd = ["x" * 101, "\u4e2d\u6587" * 80, "word " * 21, "\n" * 3 + "a,b;c" * 30, "\U0001f600" * 120, "z" * 5000]
    odd = spark.createDataFrame([(10 ** 9 + i, t) for i, t in enumerate(odd)], "doc_id long, text string")
    got = fingerprints.fingerprint_versions(docs.unionByName(odd)).filter("n_chars > 100")
    assert got.count() > 900 and got.filter("NOT near_edited > 0").count() == 0


@pytest.mark.parametrize("text", ["", "\n\n", "a", "\n\nab cd", "x" * 1000, "x" * 48 + " y", "one two three four five. " * 60,
                                  "w " * 400 + "\n" + "q" * 159 + ". end", "\U0001f600" * 400, "l\n" * 50, "a.b" * 300 + "! z"])
def test_paragraphs_of_odd_texts(spark, text):
    frame = spark.createDataFrame([(text,)], "text string")
    want = spark.createDataFrame([(p,) for p in paragraphs(text)], "p string").select(F.xxhash64("p"))
    assert sorted(frame.select(F.explode(fingerprints.digests(F.col("text")))).collect()) == sorted(want.collect())


def test_next_documents_with_ties_and_nulls(awkward):
    rows = awkward.select("doc_id", "text").collect()
    got = fingerprints.with_next(awkward).collect()
    assert len(got) == len(rows)
    assert sorted(r["text"] for r in got) == sorted(r["next_text"] for r in got) == sorted(r["text"] or "" for r in rows)
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[201]["next_text"] == "the same text again and again"
    assert by_id[10]["next_text"] == by_id[9]["text"]


def test_single_and_empty(spark, nothing):
    one = spark.createDataFrame([(5, "a line\nanother")], "doc_id long, text string")
    row = fingerprints.fingerprint_versions(one).first()
    assert (row["near_next"], row["n_chars"]) == (1.0, 14)
    assert fingerprints.fingerprint_versions(nothing).count() == 0


def test_awkward_rows(awkward):
    got = fingerprints.fingerprint_versions(awkward).collect()
    assert len(got) == awkward.count()
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)
    same = {r["fingerprint"] for r in got if r["doc_id"] is not None and r["doc_id"] >= 200}
    assert len(same) == 1


@pytest.mark.parametrize("shared, own, other", [(0, 0, 0), (5, 0, 0), (3, 1, 1), (40, 6, 5), (10, 30, 25), (0, 200, 150)])
def test_peeling_counts_differing_digests(spark, shared, own, other):
    rng = random.Random(shared + own)
    keys = [rng.getrandbits(63) for _ in range(shared + own + other)]
    frame = spark.createDataFrame([(keys[:shared + own], keys[:shared] + keys[shared + own:])],
                                  "a array<long>, b array<long>")
    a, b = F.col("a"), F.col("b")
    got = frame.select(fingerprints.differing(a, b, fingerprints.sketch(a), fingerprints.sketch(b))).first()[0]
    assert got == own + other


def test_no_python_in_the_plan(awkward):
    plan = fingerprints.fingerprint_versions(awkward)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
