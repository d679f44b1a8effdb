import random
import re
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash

from shelfmark.llm import simhash


def slow_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def smallest_reachable(prints, values):
    """Per row, the least value over its component; values may be None."""
    near = np.bitwise_count(prints[:, None] ^ prints[None]) <= 3
    top = (1 << 63) - 1
    label = np.array([top if v is None else v for v in values])
    while True:
        new = np.where(near, label[None], top).min(axis=1)
        if (new == label).all():
            return [None if v == top else int(v) for v in label]
        label = new


def test_every_two_of_five_shared_bytes_meet():
    sets = simhash.byte_sets(5)
    assert len(sets) == 14
    assert all(any(set(s) <= set(five) for s in sets) for five in combinations(range(8), 5))


def test_documents_against_brute_force(awkward):
    rows = awkward.collect()
    prints = [slow_print(r["text"]) for r in rows]
    roots = smallest_reachable(np.array(prints, np.uint64), [r["doc_id"] for r in rows])
    got = simhash.near_duplicates(awkward).collect()
    want = [(r["doc_id"], f"{p:016x}", c) for r, p, c in zip(rows, prints, roots)]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_links_lose_no_component(spark, monkeypatch):
    rng = np.random.default_rng(3)
    centres = rng.integers(0, 2 ** 63, 15, dtype=np.uint64)
    flips = rng.integers(0, 64, (120, 3), dtype=np.uint64)
    prints = np.unique(np.concatenate([centres ^ np.bitwise_or.reduce(np.uint64(1) << f) for f in flips]))
    frame = spark.createDataFrame(pd.DataFrame({"print": prints.view(np.int64)}))
    want = smallest_reachable(prints, prints.view(np.int64).tolist())
    for block in (4096, 16):        # whole lists, and lists split into blocks
        monkeypatch.setattr(simhash, "BLOCK", block)
        got = {r["node"]: r["root"] for r in simhash.fingerprint_components(frame).collect()}
        assert [got.get(p, p) for p in prints.view(np.int64).tolist()] == want


def test_forest_joins_what_is_linked():
    rng = np.random.default_rng(0)
    centres = rng.integers(0, 2 ** 63, 6, dtype=np.uint64)
    flips = rng.integers(0, 64, (500, 3), dtype=np.uint64)
    prints = np.unique(centres[rng.integers(0, 6, 500)] ^ np.bitwise_or.reduce(np.uint64(1) << flips, axis=1))
    rng.shuffle(prints)
    pairs = simhash.forest(prints, lambda one, others: np.bitwise_count(others ^ one) <= 3)
    assert len(pairs) < len(prints)
    root = list(range(len(prints)))
    for a, b in pairs:
        assert np.bitwise_count(prints[a] ^ prints[b]) <= 3
        old, new = root[b], root[a]
        root = [new if r == old else r for r in root]
    want = smallest_reachable(prints, list(range(len(prints))))
    assert len(set(zip(root, want))) == len(set(root)) == len(set(want))


def shingles(text):
    words = text.lower().split()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))}


def test_signatures_estimate_the_similarity():
    rng = np.random.default_rng(1)
    for share in (0.5, 0.8, 0.95):
        both, own = rng.integers(0, 2 ** 63, int(1000 * share), dtype=np.uint64), int(1000 * (1 - share) / 2)
        a, b = (np.concatenate([both, rng.integers(0, 2 ** 63, own, dtype=np.uint64)]) for _ in range(2))
        one, other = (np.frombuffer(simhash.byte_signature(x)[0], np.uint8) for x in (a, b))
        assert abs((one == other).mean() - share) < 0.08


def test_near_copies_go_and_others_stay(spark):
    """Copies with a few words changed, against the true similarity of every pair."""
    rng = random.Random(2)
    words = [f"w{i}" for i in range(4000)]
    texts = [" ".join(rng.choices(words, k=rng.randint(80, 400))) for _ in range(60)]
    for base in texts[:30]:
        for changes in (1, 2, 4, 60):
            copy = base.split()
            for _ in range(changes):
                copy[rng.randrange(len(copy))] = "changed" + str(rng.random())
            texts.append(" ".join(copy))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    kept = {r["doc_id"] for r in simhash.keep_one(docs).collect()}
    sets = [shingles(t) for t in texts]
    for i, own in enumerate(sets):
        like = [len(own & s) / len(own | s) for s in sets[:i]]
        if i not in kept:
            assert max(like) >= 0.7
        elif i >= 60:
            assert max(like) < 0.84


def numbered(*spans):
    """A text of numbered words: each span of numbers in turn."""
    return " ".join(f"w{i}" for a, b in spans for i in range(a, b))


def test_the_sets_decide_at_exactly_the_similarity(spark):
    """Pairs a hair on either side of 0.8, and at it: by signatures alone many fall on the wrong side."""
    texts, copies = [], []
    for k in range(60):
        start = 10_000 * k
        # 400 of 500 shingles shared; one shared less; one more shared of as many.
        one, other = [(start, start + 454)], [(start, start + 404), (start + 5000, start + 5050)]
        if k % 3 == 1:
            other[-1] = (start + 5000, start + 5051)
        if k % 3 == 2:
            other[-1] = (start + 5000, start + 5049)
        a, b = numbered(*one), numbered(*other)
        sets = shingles(a), shingles(b)
        likeness = len(sets[0] & sets[1]) / len(sets[0] | sets[1])
        assert abs(likeness - 0.8) < 0.002 and (likeness >= 0.8) == (k % 3 != 1)
        copies.append(likeness >= 0.8)
        texts += [a, b]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    kept = {r["doc_id"] for r in simhash.keep_one(docs).collect()}
    assert kept == {2 * k for k in range(60)} | {2 * k + 1 for k in range(60) if not copies[k]}


def test_near_copies_by_the_true_similarity(spark, monkeypatch):
    """What stays is one of each group of texts that pairs of 0.8 or more join, also where groups are split."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(4000)]
    texts = []
    for _ in range(12):
        base = rng.choices(words, k=rng.randint(60, 300))
        for changes in range(0, 16):
            copy = list(base)
            for _ in range(changes):
                copy[rng.randrange(len(copy))] = "changed" + str(rng.random())
            texts.append(" ".join(copy))
    rng.shuffle(texts)
    sets = [shingles(t) for t in texts]
    least = list(range(len(texts)))
    for i, j in combinations(range(len(texts)), 2):
        if len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= 0.8:
            old, new = max(least[i], least[j]), min(least[i], least[j])
            least = [new if x == old else x for x in least]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    for block in (4096, 8):
        monkeypatch.setattr(simhash, "BLOCK", block)
        assert {r["doc_id"] for r in simhash.keep_one(docs).collect()} == set(least)


def test_equal_fingerprints_alone_delete_nothing(spark):
    """Texts that are mostly zeros have the fingerprint of the zeros, whatever else they hold."""
    texts = [numbered((1000 * k, 1000 * k + 300)) + " 0" * 340 for k in range(6)]
    assert len({simhash.majority_bits(simhash.shingle_hashes(t, 5)) for t in texts}) == 1
    texts.append(texts[2] + " 0 end")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r["doc_id"] for r in simhash.keep_one(docs).collect()} == set(range(6))


def test_one_of_each_group_stays(spark, awkward):
    kept = simhash.keep_one(awkward)
    assert kept.columns == awkward.columns
    got = kept.collect()
    assert [r["doc_id"] for r in got].count(3) == 1         # repeated rows: one
    assert [r["doc_id"] for r in got if r["text"] == "the same text again and again"] == [200]
    assert [r["doc_id"] for r in got if not (r["text"] or "").split()] == [42]      # no words: one text


def test_empty_table(nothing):
    assert simhash.near_duplicates(nothing).count() == 0
    assert simhash.keep_one(nothing).count() == 0


def test_pairs_that_share_no_key_are_found(spark, monkeypatch):
    """What the signatures' keys miss, here all that they could find, the rarest shingles do not."""
    texts, kept = [], set()
    for k in range(20):
        start = 10_000 * (k + 1)
        # 400 of 500 shingles shared, or one shared less; all texts begin alike.
        shift = 51 if k % 2 else 50
        kept |= {2 * k} | ({2 * k + 1} if k % 2 else set())
        texts += [numbered((0, 30), (start, start + 424)), numbered((0, 30), (start, start + 374), (start + 5000, start + 5000 + shift))]
    sets = [shingles(t) for t in texts]
    assert [len(a & b) / len(a | b) >= 0.8 for a, b in zip(sets[::2], sets[1::2])] == [k % 2 == 0 for k in range(20)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    monkeypatch.setattr(simhash, "candidate_groups", lambda marked, similarity, bits: spark.createDataFrame([], "node long, root long"))
    for block in (4096, 8):
        monkeypatch.setattr(simhash, "BLOCK", block)
        assert {r["doc_id"] for r in simhash.keep_one(docs).collect()} == kept


def test_like_sets_share_one_of_their_rarest():
    rng = np.random.default_rng(6)
    common = np.sort(rng.integers(0, 2 ** 63, 60, dtype=np.uint64))
    counts = rng.integers(3, 90, 60)
    for n in range(1, 90):
        own = np.concatenate([rng.integers(0, 2 ** 63, n, dtype=np.uint64), common[:rng.integers(0, 60)]])
        for gone in range(len(own) // 5 + 1):
            other = rng.permutation(own)[gone:]
            if len(other) / len(own) >= 0.8:
                one, two = (simhash.rarest(x, 0.8, (common, counts)) for x in (own, other))
                assert set(one.tolist()) & set(two.tolist())
    assert len(simhash.rarest(own, 0.8, (common[:0], counts[:0]))) == len(own) - -(-len(own) * 4 // 5) + 1
    assert simhash.rarest(own[:0], 0.8, (common, counts)).tolist() == []
