"""Text cleaning as columns, keyword predicates as SQL text; all JVM-side."""

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# ---- fixed values: the description keywords of the standard reports ----
KEYWORDS = [
    "love", "war", "mystery", "fantasy", "magic", "science", "history",
    "biography", "business", "psychology", "self-help",
    "adventure", "journey", "family", "friendship", "survival",
    "dark", "emotional", "inspiring", "funny",
    "hero", "villain", "detective",
    "young", "adult", "children",
    "future", "past", "world", "society",
    "bestselling", "award",
]

# ---- fixed values: shelves that say nothing about the topic of a book ----
GENERIC_SHELVES = [
    "to-read", "currently-reading", "owned", "favorites",
    "books-i-own", "wish-list", "to-buy", "default",
]

# Two spellings of "any character but these" that Java matches several times
# faster than the plain negated class. Letters are kept with ASCII blanks;
# letters and digits with every Unicode blank and the separators 1C-1F.
KEPT = r"[a-zA-Z\s]"
NOT_LETTERS = rf"(?s)(?!{KEPT})."
NOT_ALNUM = r"(?U)[^a-zA-Z0-9\s\x1C-\x1F]"
BLANKS = r"(?U)[\s\x1C-\x1F]+"


def quoted(text: str) -> str:
    """``text`` as a SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def letters_only(text: Column) -> Column:
    """Lower case, ASCII letters and blanks only; NULL stays NULL.

    Text in other scripts becomes blank, and a hyphenated word loses its hyphen.
    """
    return F.lower(F.regexp_replace(text, NOT_LETTERS, ""))


def alnum_only(text: Column, replacement: str = "") -> Column:
    """ASCII letters, digits and blanks; NULL becomes ''.

    The default joins words around punctuation (``good,bad`` -> ``goodbad``);
    pass ``replacement=" "`` to keep them apart.
    """
    return F.coalesce(F.regexp_replace(text, NOT_ALNUM, replacement), F.lit(""))


def words(text: Column) -> Column:
    """Non-empty lower-case tokens of ``text`` in order."""
    return F.filter(F.split(F.lower(text), BLANKS), lambda w: w != "")


def mentions(lowered: str, keyword: str, match: str = "substring") -> str:
    """SQL: does already lower-cased text contain ``keyword``?

    ``substring`` also finds "war" in "award"; ``word`` wants word boundaries.
    """
    keyword = keyword.lower()
    found = f"contains({lowered}, {quoted(keyword)})"
    if match == "substring":
        return found
    if match == "word":
        literal = "".join(c if c.isalnum() else f"\\x{{{ord(c):x}}}" for c in keyword)
        # The plain search rules most texts out before the pattern is tried.
        return f"({found} AND {lowered} RLIKE {quoted(f'(?<![a-z0-9]){literal}(?![a-z0-9])')})"
    raise ValueError(f"match must be 'substring' or 'word', not {match!r}")


def keyword_total(lowered: str, keywords: Sequence[str], match: str = "substring") -> str:
    """SQL: the number of keywords that ``lowered`` contains."""
    return " + ".join(["0", *(f"int({mentions(lowered, keyword, match)})" for keyword in keywords)])
