import random
import re
import zlib
from collections import Counter, defaultdict

from shelfmark.llm import spelling

SF = "/root/testdata/sf0.01"


def by_hand(rows, typo_every=31):
    """Words, near words, forms and roots by deletion neighbourhoods on one machine."""
    lower, counts = str.maketrans(spelling.CAPITALS, spelling.SMALL), Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run[:h % len(run)] + run[h % len(run) + 1:] if h % typo_every == 0 else run] += 1
    return grouped({w: n for w, n in counts.items() if len(w) >= 7 and n >= 2})


def grouped(words):
    near, holes, form = defaultdict(set), defaultdict(set), {}
    for word in words:
        for i in range(len(word)):
            shorter = word[:i] + word[i + 1:]
            holes[i, shorter].add(word)
            if shorter in words:
                near[word].add(shorter)
                near[shorter].add(word)
    for same in holes.values():
        for word in same:
            near[word] |= same - {word}
    for word, n in words.items():
        best = min(near[word], key=lambda w: (-words[w], w), default=None)
        if best is not None and words[best] >= 10 * n:
            form[word] = best
    out = {}
    for word, n in words.items():
        root = word
        while root in form:
            root = form[root]
        out[word] = (form.get(word), root, n, len(near[word]), words.get(form.get(word)))
    return out


def as_dict(frame):
    rows = frame.collect()
    out = {r["word"]: tuple(r[c] for c in ("form", "root", "n", "n_near", "form_n")) for r in rows}
    assert len(out) == len(rows)
    return out


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    expected = by_hand(docs.select("doc_id", "text").collect())
    assert sum(v[0] is not None for v in expected.values()) > 50
    assert as_dict(spelling.spelling_variants(docs)) == expected


def test_awkward_rows(spark, awkward, nothing):
    assert as_dict(spelling.spelling_variants(awkward)) == by_hand(awkward.select("doc_id", "text").collect())
    assert as_dict(spelling.spelling_variants(nothing)) == {}


def test_crowded_chunks_are_split_and_no_pair_is_lost(spark):
    rng = random.Random(4)
    # Half of the words share their first half, so one chunk holds a third of all rows.
    words = {"straw" + "".join(rng.choice("abé") for _ in range(rng.randint(3, 6))): rng.randint(2, 500) for _ in range(900)}
    words |= {"".join(rng.choice("aé") for _ in range(rng.randint(7, 9))): rng.randint(2, 9) for _ in range(300)}
    words |= {"x" * n: 5 * n for n in range(7, 12)} | {"q" * 5000: 3, "q" * 5001: 40}
    table = spark.createDataFrame(list(words.items()), "word string, n long")
    expected = grouped(words)
    assert sum(v[3] for v in expected.values()) > 3000
    assert as_dict(spelling.group_words(table, pairs=20)) == expected
    assert as_dict(spelling.group_words(table)) == expected


def test_forms_are_followed_to_the_last(spark):
    words = {"abcdefg": 1, "abcdefgh": 10, "abcdefghi": 100, "abcdefghij": 1000, "zbcdefg": 10, "ybcdefg": 10}
    got = as_dict(spelling.group_words(spark.createDataFrame(list(words.items()), "word string, n long")))
    # Of equally frequent near words the first in code-point order is the form.
    assert got["abcdefg"] == ("abcdefgh", "abcdefghij", 1, 3, 10)
    assert got["abcdefghij"] == (None, "abcdefghij", 1000, 1, None)
