import random
import re

import pytest

from shelfmark.llm import crf, pii

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
            "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
            "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
ODD = ["", "a@b@c.com", "x@@y.z", "a.b@c..d", "a@b.c@d.e", "1.2.3.4.5.6.7.8", "999.1.1.1.1", "+1 (017) 555-7713",
       "+1......9", "1 2 3-4 5", "4111 1111 1111 1111 x", "4111111111111111", "é@x.y ü.z@q.r.s-", "a@b.c.d@e.f",
       "0001.002.3.4", "+12345678901234567890", "١٢٣.1.1.1", "x" * 5000 + "@", "1" * 5000, "9." * 3000]


def plain(text):
    """The rules as they are stated."""
    found = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            keep = {"email": True, "ip": all(len(p.lstrip("0")) < 4 and int(p) <= 255 for p in m[0].split("."))
                    if kind == "ip" else True, "card": 14 <= len(digits) <= 19 and pii.luhn(digits),
                    "phone": 10 <= len(digits) <= 15}[kind]
            if keep:
                found.append((kind, *m.span()))
    return pii.in_order(found, pii.KINDS)


@pytest.mark.parametrize("text", ODD)
def test_rules(text):
    assert pii.rule_spans(text) == plain(text)


def test_rules_on_documents(spark):
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    assert [pii.rule_spans(t) for t in texts] == [plain(t) for t in texts]


def test_chain_on_unseen_rows():
    rows = pii.labelled_rows(seed=99, each=6)
    got = pii.learnt_spans([text for text, _ in rows], pii.default_chain())
    wanted, found = ({(i, *s) for i, spans in enumerate(every) for s in spans}
                     for every in ([s for _, s in rows], got))
    assert len(wanted & found) / len(found) > 0.97 and len(wanted & found) / len(wanted) > 0.97


def test_chain_adds_what_rules_join():
    text = "Éçan 7536784127813050 4845168114407329 tre. call (017) 555-7713 now"
    rules, every = pii.all_spans([text], pii.default_chain())[0]
    assert rules == []
    assert [k for k, _, _ in every] == ["card", "card", "phone"]


def test_viterbi_is_exact():
    import itertools

    import numpy as np
    rng = np.random.default_rng(0)
    chain = crf.Chain(rng.normal(size=(crf.SLOTS, 3)), rng.normal(size=(3, 3)), 0)
    tokens = [[1, 2], [3], [4, 5, 6], [7]]
    emit = [chain.weights[t].sum(axis=0) for t in tokens]

    def total(path):
        steps = [0, *path, 0]
        return sum(e[y] for e, y in zip(emit, path)) + sum(chain.steps[a, b] for a, b in zip(steps, steps[1:]))

    best = max(itertools.product(range(3), repeat=4), key=total)
    assert tuple(chain.decode([tokens, tokens[:1]])[0]) == best


def test_awkward_rows(awkward, nothing):
    got = pii.find_private(awkward).collect()
    assert len(got) == awkward.count()
    assert pii.find_private(nothing).count() == 0
    masked = pii.mask(awkward)
    assert masked.columns == awkward.columns and masked.filter("text IS NULL").count() == 3


def test_mask(spark):
    text = "mail a.b@c.de or +1 (017) 555-7713 at 10.0.0.1."
    docs = spark.createDataFrame([(1, text, 99), (2, "clean 1984", 10)], "doc_id long, text string, n_chars long")
    got = {r["doc_id"]: r for r in pii.mask(docs).collect()}
    assert got[1]["text"] == "mail [EMAIL] or [PHONE] at [IP]."
    assert got[1]["n_chars"] == len(got[1]["text"]) and got[2]["text"] == "clean 1984"


def test_long_runs_and_many_spans_take_little_time():
    zeros = "0" * 10_000
    assert pii.rule_spans(f"{zeros}.1.1.1 1{zeros}.1.1.1 {zeros}255.0.0.256") == [("ip", 0, 10_006)]
    assert len(pii.rule_spans("user.name@mail.example.com " * 38_000)) == 38_000
    spans = [("email", 10 * i, 10 * i + 8) for i in range(100_000)]
    assert pii.untouched([("phone", start + 8, start + 10) for _, start, _ in spans], spans) == \
        [("phone", start + 8, start + 10) for _, start, _ in spans]


def test_untouched_against_all_pairs():
    rng = random.Random(8)
    for _ in range(300):
        fixed = sorted((("a", s, s + rng.randint(1, 9)) for s in (rng.randint(0, 40) for _ in range(5))), key=lambda f: f[1])
        spans = [("b", s, s + rng.randint(1, 6)) for s in (rng.randint(0, 45) for _ in range(6))]
        assert pii.untouched(spans, fixed) == [s for s in spans if not any(s[1] < f[2] and f[1] < s[2] for f in fixed)]


def test_long_digits_on_spark(spark):
    docs = spark.createDataFrame([(1, "0" * 5000 + ".1.1.1"), (2, "9" * 10_000 + ".1.1.1"), (2, "a@b.cd " * 20_000)],
                                 "doc_id long, text string")
    assert sorted(len(r["rule_spans"]) for r in pii.find_private(docs).collect()) == [0, 1, 20_000]
    assert pii.mask(docs).count() == 3
