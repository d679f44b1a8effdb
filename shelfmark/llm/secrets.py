"""Secret scans: a trigram index of the texts picks the candidates that each rule is tried on."""

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .pii import untouched
from .trigrams import Query, query_of

Span = tuple[str, int, int]
#: Texts indexed together are at most this many characters, unless one alone is longer.
SEGMENT_CHARS = 2_000_000


@dataclass(frozen=True)
class Rule:
    """A kind of secret: its pattern, and the least length of group ``group``."""
    kind: str
    pattern: str
    least: int = 0
    group: int = 0
    ignore_case: bool = False

    @cached_property
    def compiled(self) -> re.Pattern:
        return re.compile(self.pattern, self.flags)

    @property
    def flags(self) -> int:
        # ASCII: letters of other scripts that fold to ASCII ones are no matches.
        return re.ASCII | re.IGNORECASE if self.ignore_case else re.ASCII

    @cached_property
    def query(self) -> Query:
        return query_of(self.pattern, self.flags)

    def spans(self, text: str) -> Iterator[Span]:
        for m in self.compiled.finditer(text):
            if m.end(self.group) - m.start(self.group) >= self.least:
                yield self.kind, *m.span()


# The three rules that always hold, then formats of well-known keys.
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         least=6, group=2, ignore_case=True),
    Rule("access", r"AKIA[A-Z0-9]+", least=20),
    # Shorter runs never count and never overlap longer ones, so they need not be matched.
    Rule("hex", r"(?<![0-9a-f])[0-9a-f]{24,}"),
)
MORE = (
    Rule("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("repository_token", r"gh[opsur]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"xox[abeoprs]-[A-Za-z0-9-]{10,}"),
    Rule("payment_key", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("cloud_key", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("hex", r"(?<![0-9A-Fa-f])(?=[0-9A-F]{0,200}[A-F])[0-9A-F]{32,}(?![0-9A-Za-z])"),
)
RULES = BASE + MORE


def _code(trigram: bytes) -> int:
    return trigram[0] << 16 | trigram[1] << 8 | trigram[2]


class Index:
    """Postings of a segment of texts: for each trigram that some rule asks for, the texts that hold it.

    Trigrams are of bytes, A to Z in small letters. The vocabulary is that of the rules'
    queries: no other postings would ever be read.
    """

    def __init__(self, texts: Sequence[str], trigrams: Sequence[str]):
        self.count = len(texts)
        codes = sorted({_code(t.encode()) for t in trigrams if len(t.encode()) == 3})
        wanted = np.zeros(1 << 24, np.uint8)
        wanted[codes] = 1
        raw = [t.encode("utf-8", "replace").lower() for t in texts]
        # A zero byte parts the texts: no trigram reaches over it.
        data = np.frombuffer(b"\0".join(raw) + b"\0\0", np.uint8).astype(np.uint32)
        at = data[:-2] << 16 | data[1:-1] << 8 | data[2:]
        hits = np.flatnonzero(wanted[at])
        starts = np.cumsum([0] + [len(r) + 1 for r in raw])
        owner = np.searchsorted(starts, hits, side="right") - 1
        pairs = np.unique(at[hits].astype(np.int64) * max(self.count, 1) + owner)
        found, texts_of = pairs // max(self.count, 1), pairs % max(self.count, 1)
        bounds = np.searchsorted(found, codes), np.searchsorted(found, codes, side="right")
        self.postings = {code: texts_of[a:b] for code, a, b in zip(codes, *bounds)}

    def matching(self, query: Query) -> np.ndarray:
        """Numbers of the texts that satisfy a query, by intersecting and uniting postings."""
        found = None
        lists = [self.postings.get(_code(t.encode()), np.zeros(0, np.int64)) for t in query.all
                 if len(t.encode()) == 3]
        for posting in sorted(lists, key=len):
            found = posting if found is None else np.intersect1d(found, posting, assume_unique=True)
        for options in query.either:
            union = np.unique(np.concatenate([self.matching(q) for q in options]))
            found = union if found is None else np.intersect1d(found, union, assume_unique=True)
        return np.arange(self.count) if found is None else found


def indexed(texts: Sequence[str], rules: Sequence[Rule]) -> Index:
    """The index that the rules' queries need."""
    return Index(texts, [t for rule in rules for t in rule.query.trigrams()])


def scan(texts: Sequence[str], rules: Sequence[Rule], index: Index) -> list[list[Span]]:
    """Per text, the spans of the rules: each tried on the texts that satisfy its query, or on all if it has none."""
    found: list[list[Span]] = [[] for _ in texts]
    for rule in rules:
        for i in index.matching(rule.query).tolist():
            found[i] += rule.spans(texts[i])
    return found


def in_order(spans: Sequence[Span], kinds: Sequence[str]) -> list[Span]:
    return sorted(set(spans), key=lambda s: (s[1], kinds.index(s[0]), s[2]))


def _segments(texts: list[str]) -> Iterator[list[str]]:
    segment, chars = [], 0
    for text in texts:
        if segment and chars + len(text) > SEGMENT_CHARS:
            yield segment
            segment, chars = [], 0
        segment.append(text)
        chars += len(text)
    yield segment


def find_secrets(docs: DataFrame, rules: Sequence[Rule] = MORE, text: str = "text",
                 doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, rule_spans, spans) of every row: arrays of (kind, start, end), in code points, end exclusive.

    ``rule_spans`` are those of the base rules; ``spans`` adds those of ``rules`` that
    touch none of them. Each Arrow batch is cut into segments with an index each, so an
    index never outgrows its task. A NULL or empty text has no spans; equal rows agree;
    an empty table gives no rows.
    """
    every = (*BASE, *rules)
    kinds = list(dict.fromkeys(rule.kind for rule in every))
    one = "array<struct<kind:string,start:int,end:int>>"

    def as_rows(spans: list[Span]) -> list[dict]:
        return [dict(zip(("kind", "start", "end"), s)) for s in spans]

    @F.pandas_udf(f"rules {one}, spans {one}")
    def found(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for segment in _segments(texts.tolist()):
            index = indexed(segment, every)
            for base, more in zip(scan(segment, BASE, index), scan(segment, rules, index)):
                base = in_order(base, kinds)
                rows.append((as_rows(base), as_rows(in_order([*base, *untouched(more, base)], kinds))))
        return pd.DataFrame(rows, columns=["rules", "spans"])

    return docs.select(F.col(doc_id).alias("doc_id"),
                       found(F.coalesce(F.col(text), F.lit(""))).alias("found")).select(
        "doc_id", F.col("found.rules").alias("rule_spans"), F.col("found.spans").alias("spans"))
