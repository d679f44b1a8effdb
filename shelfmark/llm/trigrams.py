"""Boolean trigram queries that a text must satisfy for a regular expression to match in it."""

from dataclasses import dataclass
from itertools import product
from re import _constants as op, _parser

#: Sets of strings larger than this are no longer followed exactly.
MOST_STRINGS = 64


@dataclass(frozen=True)
class Query:
    """``all`` of the trigrams and, for each of ``either``, one of its queries. Empty: any text."""
    all: frozenset[str] = frozenset()
    either: frozenset[frozenset["Query"]] = frozenset()

    def __bool__(self) -> bool:
        return bool(self.all or self.either)

    def both(self, other: "Query") -> "Query":
        return Query(self.all | other.all, self.either | other.either)

    def trigrams(self) -> set[str]:
        return set(self.all).union(*(q.trigrams() for options in self.either for q in options))


ANY = Query()


def either(queries: list[Query]) -> Query:
    """One of several queries: any text if one of them is."""
    distinct = frozenset(queries)
    if not distinct or any(not q for q in distinct):
        return ANY
    return next(iter(distinct)) if len(distinct) == 1 else Query(either=frozenset([distinct]))


def of_string(text: str) -> Query:
    return Query(frozenset(text[i:i + 3] for i in range(len(text) - 2)))


def of_strings(texts: set[str]) -> Query:
    return either([of_string(t) for t in texts])


@dataclass(frozen=True)
class _Part:
    """What is known of the texts that a piece of an expression matches.

    ``exact`` are all of them, if they are few; else they begin with one of ``first``, end
    with one of ``last`` and satisfy ``query``.
    """
    exact: frozenset[str] | None
    first: frozenset[str] = frozenset([""])
    last: frozenset[str] = frozenset([""])
    query: Query = ANY

    def open(self) -> "_Part":
        """The same without the exact set."""
        return self if self.exact is None else _Part(None, self.exact, self.exact, of_strings(set(self.exact)))


_UNKNOWN = _Part(None)


def _joined(a: _Part, b: _Part) -> _Part:
    if a.exact is not None and b.exact is not None and len(a.exact) * len(b.exact) <= MOST_STRINGS:
        return _Part(frozenset(map("".join, product(a.exact, b.exact))))
    left, right = a.open(), b.open()
    across = ANY
    if len(left.last) * len(right.first) <= MOST_STRINGS:
        across = of_strings({x[-2:] + y[:2] for x, y in product(left.last, right.first)})
    first, last = left.first, right.last
    if a.exact is not None and len(a.exact) * len(right.first) <= MOST_STRINGS:
        first = frozenset(map("".join, product(a.exact, right.first)))
    if b.exact is not None and len(b.exact) * len(left.last) <= MOST_STRINGS:
        last = frozenset(map("".join, product(left.last, b.exact)))
    return _Part(None, first, last, left.query.both(right.query).both(across).both(of_strings(set(first)))
                 .both(of_strings(set(last))))


def _one_of(parts: list[_Part]) -> _Part:
    if all(p.exact is not None for p in parts):
        every = frozenset().union(*(p.exact for p in parts))
        if len(every) <= MOST_STRINGS:
            return _Part(every)
    parts = [p.open() for p in parts]
    return _Part(None, frozenset().union(*(p.first for p in parts)), frozenset().union(*(p.last for p in parts)),
                 either([p.query for p in parts]))


def _characters(items: list) -> _Part:
    """A class of characters, by their small letters."""
    found: set[str] = set()
    for kind, value in items:
        if kind is op.LITERAL:
            found.add(chr(value).lower())
        elif kind is op.RANGE and value[1] - value[0] < MOST_STRINGS:
            found.update(chr(c).lower() for c in range(value[0], value[1] + 1))
        else:
            return _UNKNOWN
    return _Part(frozenset(found)) if len(found) <= 8 else _UNKNOWN


def _known(tree) -> _Part:
    part = _Part(frozenset([""]))
    for kind, value in tree:
        if kind is op.LITERAL:
            piece = _Part(frozenset([chr(value).lower()]))
        elif kind is op.IN:
            piece = _characters(value)
        elif kind is op.BRANCH:
            piece = _one_of([_known(branch) for branch in value[1]])
        elif kind is op.SUBPATTERN:
            piece = _known(value[-1])
        elif kind is op.ATOMIC_GROUP:
            piece = _known(value)
        elif kind in (op.AT, op.ASSERT, op.ASSERT_NOT):
            continue        # matches nothing by itself
        elif kind in (op.MAX_REPEAT, op.MIN_REPEAT, op.POSSESSIVE_REPEAT):
            least, most, inner = value
            once = _known(inner)
            if (least, most) == (0, 1):
                piece = _one_of([_Part(frozenset([""])), once])
            elif least == 0:
                piece = _UNKNOWN
            else:
                piece = once
                for _ in range(min(least, 3) - 1):
                    piece = _joined(piece, once)
                if most != least or least > 3:
                    piece = _Part(None, piece.open().first, piece.open().last, piece.open().query)
        else:
            piece = _UNKNOWN
        part = _joined(part, piece)
    return part


def query_of(pattern: str, flags: int = 0) -> Query:
    """What the small letters of a text must hold for ``pattern`` to match somewhere; empty if nothing can be said.

    All literals are taken in small letters, so the query serves either case.
    """
    return _known(_parser.parse(pattern, flags)).open().query
