import re

from shelfmark.llm import secrets, trigrams

ODD = ["AKIA" + "A" * 16, "AKIAAKIA" + "0" * 20, "xAKIA1", 'my API_KEY : "abcdef"', "Paſsword=abcdefg", "toKen=abc",
       "apikey  =  'ABCDEFG==", 'secret"=x.y.z1', "a" * 30, "0123456789abcdef01234567", "ghp_" + "a1" * 20,
       "-----BEGIN RSA PRIVATE KEY-----", "", " ", "token=token=secret:abcdefgh", "PASSWD:" + " " * 3000 + "abcdef"]
PLAIN = {"assign": (re.compile(
    r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD])|(?:[pP][aA][sS][sS][wW][dD])|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"""
    r"""|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), lambda m: len(m[2]) >= 6),
    "access": (re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
    "hex": (re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 24)}


def plain(text):
    return sorted((kind, *m.span()) for kind, (pattern, keep) in PLAIN.items() for m in pattern.finditer(text) if keep(m))


def all_rules(texts, rules):
    return secrets.scan(texts, rules, secrets.indexed(texts, rules))


def test_base_rules(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()
    texts = [r["text"] for r in rows] + ODD
    assert [sorted(s) for s in all_rules(texts, secrets.BASE)] == [plain(t) for t in texts]


def test_index_loses_no_match():
    texts = ODD + ["x " + t + " y" for t in ODD] + ["AIza" + "x" * 35, "eyJabcdefgh1.eyJabcdefgh2.sig_nature-1",
                                                    "sk_live_" + "1a" * 10, "xoxb-123456789012", "F0" * 20]
    every = all_rules(texts, secrets.RULES)
    full = [[s for rule in secrets.RULES for s in rule.spans(t)] for t in texts]
    assert [sorted(s) for s in every] == [sorted(s) for s in full]
    assert {s[0] for spans in every for s in spans} == {r.kind for r in secrets.RULES}


def test_queries():
    assert trigrams.query_of("abcd") == trigrams.Query(frozenset(["abc", "bcd"]))
    assert not trigrams.query_of("[0-9a-f]{24,}") and not trigrams.query_of("a?b?c?")
    assert not trigrams.query_of("(abc)?d|xyz")       # one branch says nothing
    assert trigrams.query_of("AKIA[A-Z0-9]+").all == {"aki", "kia"}
    both = trigrams.query_of("(foo|bar)baz")
    assert {frozenset(q.all) for q in next(iter(both.either))} == {
        frozenset(["foo", "oob", "oba", "baz"]), frozenset(["bar", "arb", "rba", "baz"])}
    assert trigrams.query_of("x.*secret").all >= {"sec", "ecr", "cre", "ret"}
    assert "ababa"[:3] in trigrams.query_of("(ab){2,}").all


def test_rules_without_trigrams_scan_all():
    texts = ["nothing here", "f" * 24]
    index = secrets.indexed(texts, secrets.BASE)
    assert index.matching(secrets.BASE[2].query).tolist() == [0, 1]
    assert index.matching(secrets.BASE[1].query).tolist() == []


def test_awkward_rows(awkward, nothing):
    got = secrets.find_secrets(awkward).collect()
    assert len(got) == awkward.count() and secrets.find_secrets(nothing).count() == 0
    assert all(set(r["rule_spans"]) <= set(r["spans"]) for r in got)
