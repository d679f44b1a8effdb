"""Personal data in texts: exact rules, and a conditional random field that finds what they miss."""

import random
import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache
from itertools import accumulate

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from . import crf

KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]

# ------------------------------------------------------------------------ exact rules

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_NOT_LOCAL = re.compile(r"[^A-Za-z0-9._%+-]")
# A match never begins within a run of digits, so such starts need not be tried.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    """Around each @: the longest local part before it that no earlier match took, and the domain after it."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and not _NOT_LOCAL.match(text, start - 1):
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            yield "email", start, end
        else:
            end = max(end, at + 1)      # no later match reaches back over this sign
        at = text.find("@", at + 1)


def rule_spans(text: str) -> list[Span]:
    """(kind, start, end) in code points, by start, then in the order of ``KINDS``."""
    found = list(_emails(text))
    if _DIGIT.search(text):
        found += [("ip", *m.span()) for m in _IP.finditer(text)
                  if all(len(part) <= 3 and int(part or "0") <= 255
                         for part in (digits.lstrip("0") for digits in m[0].split(".")))]
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", *m.span()))
        if "+" in text:
            found += [("phone", *m.span()) for m in _PHONE.finditer(text)
                      if 10 <= sum(c in "0123456789" for c in m[0]) <= 15]
    return in_order(found, KINDS)


def in_order(spans: Iterable[Span], kinds: Sequence[str]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], kinds.index(s[0]), s[2]))


def untouched(spans: Iterable[Span], fixed: Sequence[Span]) -> list[Span]:
    """Those of ``spans`` that share no character with any of ``fixed``, which come by start."""
    starts = [f[1] for f in fixed]
    # The furthest that the first so many of them reach.
    reach = list(accumulate((f[2] for f in fixed), max, initial=0))
    return [s for s in spans if reach[bisect_left(starts, s[2])] <= s[1]]


def joined(spans: Iterable[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


# ------------------------------------------------------------- what the field looks at

_TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
_SIGNAL = re.compile(r"[0-9@]")
#: Tokens without a digit or @ further than this from one that has either are never private.
REACH = 2
LABELS = ("O", *(f"{place}-{kind}" for kind in KINDS for place in "BI"))


def shape(token: str) -> str:
    """Runs of capitals, small letters, other letters and digits as A, a, x and 9; other signs as they are."""
    kinds = ("9" if c in "0123456789" else "x" if ord(c) > 127 else "A" if c.isupper() else "a" if c.islower() else c
             for c in token[:40])
    runs: list[str] = []
    for kind in kinds:
        if not runs or runs[-1] != kind:
            runs.append(kind)
    return "".join(runs)


def _own(token: str) -> list[str]:
    """What a token shows by itself."""
    digits = "".join(c for c in token[:80] if c in "0123456789")
    parts = token.strip(".,;:!?()[]\"'").split(".")
    ip = len(parts) == 4 and all(p.isascii() and p.isdigit() and len(p) <= 3 and int(p) <= 255 for p in parts)
    names = [f"shape {shape(token)}", f"digits {min(len(digits), 20)}", f"start {shape(token[:1])}",
             f"end {shape(token[-1:])}", "at" if "@" in token[1:-1] and "." in token.split("@")[-1][1:] else "no at",
             "four parts" if ip else "no parts"]
    names += ["sum holds" if luhn(digits) else "sum fails"] if 13 <= len(digits) <= 19 else []
    groups = "-".join(str(len(g)) for g in re.findall("[0-9]+", token[:80]))
    return names + [f"groups {groups}", f"word {token.strip('.,:;()').lower()[:12]}"]


def token_slots(tokens: Sequence[str]) -> list[list[int]]:
    own = [_own(t) for t in tokens]
    rows = []
    for i, names in enumerate(own):
        around = [f"{where} {name}" for where, j in (("before", i - 1), ("after", i + 1), ("before that", i - 2))
                  for name in ((own[j][0], own[j][1], own[j][-1]) if 0 <= j < len(own) else ("none",))]
        rows.append(crf.slots(["any", *names, *around]))
    return rows


def windows(text: str) -> list[list[tuple[int, int]]]:
    """Runs of tokens (start, end) within ``REACH`` of one with a digit or an @: all that can be private."""
    if not _SIGNAL.search(text):
        return []
    spans = [m.span() for m in _TOKEN.finditer(text)]
    runs: list[list[tuple[int, int]]] = []
    upto = 0        # tokens before this one are in a run already, or out of reach
    for i, (start, end) in enumerate(spans):
        if _SIGNAL.search(text, start, end):
            begin = max(i - REACH, upto)
            if not runs or begin > upto:
                runs.append([])
            runs[-1] += spans[begin:i + REACH + 1]
            upto = i + REACH + 1
    return runs


# --------------------------------------------------------------------- what it learns from

# A small labelled table. [kind ...] marks private data; # stands for any
# digit, ? for a digit of at most 255, $ for a number whose check sum holds, ~ for a word.
LABELLED = (
    "~ ~ [email ~.##@~#.example.com] ~ ~", "~: [email ~@~.example.org], ~", "write to [email ~_##@~.net]. ~ ~",
    "~ <[email ~.~@~.example.com]> ~ ~", "mail [email é~@~.example.com] ~ ~", "~ [email ~+##@~.co.uk] ~",
    "~ [ip ?.?.?.?] ~ ~", "~ from [ip ?.?.?.?], ~ ~", "~ ~ [ip ?.?.?.?]. ~", "~ [ip ?.?.?.?] [ip ?.?.?.?] ~",
    "~ ~ [card $] ~ ~", "card [card $], ~ ~", "~ [card $]. ~", "~ ~ [card $] ~ ~",
    "~ ~ [phone +# (###) ###-####] ~ ~", "~ [phone +# ### ### ####] ~ ~", "call [phone +##-###-#######] ~ ~",
    "~ [phone +# (###) ###-####] ~. ~", "tel. [phone +## ### #######], ~", "~ [phone +1 (0##) 555-####] ~ ~",
    "~ ~ [phone (###) ###-####] ~ ~", "~ [phone ###-###-####] ~ ~", "call [phone (0##) 555-####] ~ ~",
    "phone [phone ###-###-####], ~ ~", "~: [phone (###) ###-####]. ~", "tel [phone 0## 555-####] ~",
    "~ ~ #### ~ ~", "~ in 19## ~ ~", "~ in 20##, ~ ~", "~ ## ~ ~", "~ # ~ ~", "~ ~ ### ~", "~ ~ #, ~ ##. ~",
    "~ #.# ~ ~", "~ #.#.# ~", "version #.##.# ~ ~", "~ $##.## ~", "~ ##% ~ ~", "~ ##:## ~ ~", "~ #-# ~ ~",
    "~ 20##-0#-1# ~ ~", "~ ##/##/#### ~", "~ ###-#### ~ ~", "~ ##########~ ~ ~", "~ #########, ~ ~",
    "~ a#f#c#d#e# ~ ~", "~ token = a##b##c##d##e##f## ~", "~ @~ ~ ~", "~ ~@ ~ ~", "~ @ ~ ~", "~ ~#~ ~ ~",
    "~ (##) ~ ~", "~ [##] ~ ~", "~ ### ### ~ ~", "~ #,### ~ ~", "no. ##### ~ ~", "~ ##### ~ ~", "~ ###### ~ ~",
    "~ !################ ~ ~", "~ ~ !################, ~", "~ 2##.3##.4##.5## ~", "~ ~-## ~ ~", "~ ##~ ~ ~",
    "| ## | ### | #### | ~", "# ## ### ## # ##", "~ ## ## ## ~ ~", "~: ###; ~: ##; ~", "copyright (c) 20## ~ ~",
    "license version #.# (20##) ~", "~ ### - #### ~", "~ 1, 2, 3, 4 ~", "isbn ###-#-##-######-# ~", "~ $# ~ ~",
)
_MARK = re.compile(r"\[(email|ip|card|phone) ([^\]]*)\]")


def labelled_rows(rows: Sequence[str] = LABELLED, each: int = 12, seed: int = 5) -> list[tuple[str, list[Span]]]:
    """(text, spans) made from marked rows, ``each`` row written out so many times."""
    rng = random.Random(seed)

    def word(_) -> str:
        made = "".join(rng.choice("abcdefghijklmnopqrstuvwyzéüñ") for _ in range(rng.randint(2, 10)))
        return made.capitalize() if rng.random() < 0.15 else made

    def number(holds: bool) -> str:
        while True:
            digits = "".join(rng.choice("0123456789") for _ in range(16))
            if luhn(digits) is holds:
                return digits

    def fill(row: str) -> str:
        row = re.sub(r"\$(?![0-9#])", lambda _: number(True), row)
        row = row.replace("!################", number(False))
        row = re.sub(r"\?", lambda _: str(rng.randint(0, 255)), row)
        row = re.sub("#", lambda _: str(rng.randint(0, 9)), row)
        return re.sub("~", word, row)

    made = []
    for row in rows:
        for _ in range(each):
            text, spans, rest = "", [], 0
            for m in _MARK.finditer(row):
                text += fill(row[rest:m.start()])
                inner = fill(m[2])
                if m[1] == "card" and rng.random() < 0.4:
                    inner = rng.choice(" -.").join(inner[k:k + 4] for k in range(0, 16, 4))
                spans.append((m[1], len(text), len(text) + len(inner)))
                text, rest = text + inner, m.end()
            made.append((text + fill(row[rest:]), spans))
    return made


@lru_cache(maxsize=1)
def default_chain() -> crf.Chain:
    return train(labelled_rows())


def train(rows: Sequence[tuple[str, Sequence[Span]]]) -> crf.Chain:
    """A chain from a small table of texts and their private spans."""
    sequences, labels = [], []
    for text, spans in rows:
        for run in windows(text):
            owners = [next((s for s in spans if s[1] < end and start < s[2]), None) for start, end in run]
            sequences.append(token_slots([text[a:b] for a, b in run]))
            labels.append([0 if s is None else LABELS.index(
                ("I-" if k and owners[k - 1] is s else "B-") + s[0]) for k, s in enumerate(owners)])
    begins = [LABELS.index(f"B-{kind}") for kind in KINDS]
    allowed = crf.allowed_steps(begins, [b + 1 for b in begins], len(LABELS))
    return crf.train(sequences, labels, allowed)


_EDGES = {"email": (".,;:!?()[]<>\"'", ".,;:!?()[]<>\"'-"), "ip": (".,;:!?()[]\"'", ".,;:!?()[]\"'"),
          "card": (".,;:!?()[]\"'", ".,;:!?()[]\"'"), "phone": (".,;:!?[]\"'", ".,;:!?([]\"'")}


def learnt_spans(texts: Sequence[str], chain: crf.Chain) -> list[list[Span]]:
    """Per text, the spans the chain finds: whole tokens without the signs around them."""
    runs = [(i, run) for i, text in enumerate(texts) for run in windows(text)]
    paths = chain.decode([token_slots([texts[i][a:b] for a, b in run]) for i, run in runs]) if runs else []
    found: list[list[Span]] = [[] for _ in texts]
    for (i, run), path in zip(runs, paths):
        k = 0
        while k < len(path):
            first = k
            k += 1
            if path[first] == 0:
                continue
            while k < len(path) and path[k] == path[first] + 1 and LABELS[path[k]][0] == "I":
                k += 1
            kind = LABELS[path[first]][2:]
            start, end = run[first][0], run[k - 1][1]
            inner = texts[i][start:end]
            start += len(inner) - len(inner.lstrip(_EDGES[kind][0]))
            end -= len(inner) - len(inner.rstrip(_EDGES[kind][1]))
            if start < end:
                found[i].append((kind, start, end))
    return found


def all_spans(texts: Sequence[str], chain: crf.Chain) -> list[tuple[list[Span], list[Span]]]:
    """Per text: the spans of the rules, and these with the learnt ones that touch none of them."""
    rules = [rule_spans(t) for t in texts]
    both = []
    for fixed, learnt in zip(rules, learnt_spans(texts, chain)):
        both.append((fixed, in_order([*fixed, *untouched(learnt, fixed)], KINDS)))
    return both


# --------------------------------------------------------------------------------- on Spark

#: Texts are labelled this many characters at a time, so a batch of long ones takes no more memory.
BATCH_CHARS = 2_000_000


def _parts(texts: list[str]) -> Iterator[list[str]]:
    part, chars = [], 0
    for text in texts:
        part.append(text)
        chars += len(text)
        if chars >= BATCH_CHARS:
            yield part
            part, chars = [], 0
    yield part


def find_private(docs: DataFrame, chain: crf.Chain | None = None, text: str = "text",
                 doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, rule_spans, spans) of every row: arrays of (kind, start, end), in code points, end exclusive.

    A NULL or empty text has none; a text of any length is read whole, though what the
    field sees of a token is its first 80 characters. Rows are labelled each by itself, so equal rows agree,
    ids may repeat or be NULL, and an empty table gives no rows.
    """
    chain = chain or default_chain()
    one = "array<struct<kind:string,start:int,end:int>>"

    @F.pandas_udf(f"rules {one}, spans {one}")
    def labelled(texts: pd.Series) -> pd.DataFrame:
        found = [f for part in _parts(texts.tolist()) for f in all_spans(part, chain)]
        as_rows = [[[dict(zip(("kind", "start", "end"), s)) for s in spans] for spans in pair] for pair in found]
        return pd.DataFrame(as_rows, columns=["rules", "spans"])

    return docs.select(F.col(doc_id).alias("doc_id"),
                       labelled(F.coalesce(F.col(text), F.lit(""))).alias("found")).select(
        "doc_id", F.col("found.rules").alias("rule_spans"), F.col("found.spans").alias("spans"))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                                 s["end"].cast("string"))), ",")


def masked_text(text: str, spans: Sequence[Span]) -> str:
    """``text`` with each span, or run of overlapping spans, replaced by its kind in brackets."""
    parts, end = [], 0
    for kind, start, stop in spans:
        if start >= end:
            parts += [text[end:start], f"[{kind.upper()}]"]
        end = max(end, stop)
    return "".join(parts) + text[end:]


def mask(docs: DataFrame, chain: crf.Chain | None = None, text: str = "text") -> DataFrame:
    """``docs`` in their columns, private data in the texts replaced; NULL stays NULL, an empty text empty.

    Equal rows stay equal, texts of any length are read whole, no rows give no rows.
    A column ``n_chars`` counts the characters again.
    """
    chain = chain or default_chain()

    @F.pandas_udf(T.StringType())
    def masked(texts: pd.Series) -> pd.Series:
        plain = texts.tolist()
        spans = [every for part in _parts([t or "" for t in plain]) for _, every in all_spans(part, chain)]
        return pd.Series([None if t is None else masked_text(t, s) for t, s in zip(plain, spans)], dtype=object)

    changed = docs.withColumn(text, masked(F.col(text)))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed = changed.withColumn("n_chars", F.length(text).cast(kind))
    return changed
