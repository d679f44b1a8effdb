"""Packing token sequences into rows of fixed length by best fit and swap-based local search."""

import base64
import re
import zlib
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..checkpoints import materialise

#: Pieces that one task packs together: bounds its memory, and leaves it one or two underfull rows in thousands.
BLOCK = 16_384
#: The token that the vocabulary adds to those of the ranks, one id wherever a text holds it.
ADDED, ADDED_ID = "<|endoftext|>", 50256
#: A run of this many blanks is taken out before the pattern's search, which fails at some 700,000.
LONG_RUN = 100_000
#: What the pattern takes for blanks; Python's own class holds four more.
_BLANKS = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")


@lru_cache(maxsize=2)
def _encoding(ranks_path: str, pattern: str):
    """The vocabulary, read once in each worker: a base64 token and its id on each line."""
    import tiktoken

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def token_ids(encoding, text: str) -> np.ndarray:
    """The ids of a text, as the vocabulary's own file gives them: ``ADDED`` is one id, all else follows the ranks."""
    parts = []
    for number, body in enumerate(text.split(ADDED)):
        if number:
            parts.append([ADDED_ID])
        at = 0
        for run in _BLANKS.finditer(body) if len(body) >= LONG_RUN else ():
            if run.end() - run.start() >= LONG_RUN:
                # The pattern takes a run as one, but for its last blank if more text follows.
                end = run.end() - (run.end() < len(body))
                parts += [encoding.encode_to_numpy(body[at:run.start()], disallowed_special=()),
                          encoding._encode_single_piece(body[run.start():end])]
                at = end
        parts.append(encoding.encode_to_numpy(body[at:], disallowed_special=()))
    return np.concatenate([np.asarray(p, dtype="<u4") for p in parts])


def cut(total: int, length: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document: full ones, but for the first."""
    first = total % length or min(total, length)
    return [(0, first)] + [(start, length) for start in range(first, total, length)]


def tokenised_pieces(docs: DataFrame, ranks_path: str, pattern: str, length: int, end_id: int,
                     text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, _row): the pieces of every text, the ids themselves left behind."""
    end = np.array([end_id], dtype="<u4").tobytes()

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoding = _encoding(ranks_path, pattern)
        for batch in batches:
            rows = []
            for key, row, body in zip(batch["_id"], batch["_row"], batch["_text"]):
                ids = token_ids(encoding, body).tobytes() + end
                for number, (start, count) in enumerate(cut(len(ids) // 4, length)):
                    rows.append((key, row, number, start, count, zlib.crc32(ids[4 * start:4 * (start + count)])))
            yield pd.DataFrame(rows, columns=["_id", "_row", "piece", "start", "length", "ids_crc32"])

    rows = docs.select(F.col(doc_id).alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("_text"),
                       F.monotonically_increasing_id().alias("_row"))
    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInPandas(pieces, f"_id {kind}, _row long, piece int, start long, length long, ids_crc32 long")


# ------------------------------------------------------------------------------ bins

def best_fit(lengths: np.ndarray, room: int) -> list[list[int]]:
    """Bins of piece numbers: longest pieces first, each to the fullest bin it fits."""
    bins: list[list[int]] = []
    open_bins: list[tuple[int, int]] = []       # (room left, bin), sorted
    for i in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[i])
        at = bisect_left(open_bins, (need, -1))
        left, b = open_bins.pop(at) if at < len(open_bins) else (room, len(bins))
        if b == len(bins):
            bins.append([])
        bins[b].append(i)
        if left > need:
            insort(open_bins, (left - need, b))
    return bins


def swap_search(bins: list[list[int]], lengths: np.ndarray, room: int) -> list[list[int]]:
    """Fewer bins: documents moved or exchanged while the sum of squared fills grows.

    The emptiest underfull bin gives. Of all exchanges with the other underfull bins, the
    one that shifts most tokens away from it is made, again and again: a move, one
    document for one, one for two, or two for one. Tokens shifted to a fuller bin raise
    the sum of squares, so this ends. A bin left empty is dropped; one that cannot give
    any more is set aside, and the next emptiest gives, until the others' room is less
    than its fill.
    """
    done = [b for b in bins if lengths[b].sum() == room]
    under = sorted((list(b) for b in bins if lengths[b].sum() < room), key=lambda b: int(lengths[b].sum()))
    tables = [_returns(lengths[b], room) for b in under]
    spare = sum(room - int(lengths[b].sum()) for b in under)
    for number, giver in enumerate(under):
        fill = int(lengths[giver].sum())
        if spare - (room - fill) < fill:
            break
        tables[number] = tables[number][:, :0]
        while giver:
            outs, out_sums = _leaving(lengths[giver])
            back, left, at = _joined(tables)
            shifts = out_sums[:, None] - back
            shifts[(shifts <= 0) | (shifts > left) | ((back == 0) & (np.array(list(map(len, outs))) == 2)[:, None])] = 0
            best = int(shifts.argmax()) if shifts.size else 0
            if not shifts.size or not shifts.flat[best]:
                break
            out, option = outs[best // len(back)], best % len(back)
            taker = under[at[option]]
            first, second = (int(tables[at[option]][row, option - np.searchsorted(at, at[option])]) for row in (2, 3))
            enter = [taker[j] for j in (first, second) if j >= 0]
            leave = [giver[i] for i in out]
            giver[:] = [i for i in giver if i not in leave] + enter
            taker[:] = [j for j in taker if j not in enter] + leave
            tables[at[option]] = _returns(lengths[taker], room)
        spare -= room - fill if giver else room
        if giver:
            tables[number] = _returns(lengths[giver], room)
            spare += room - int(lengths[giver].sum())
    return done + [b for b in under if b]


def _returns(sizes: np.ndarray, room: int) -> np.ndarray:
    """What a bin can give back: rows sum, room left, and the places of the one or two documents (-1: none)."""
    seen = Counter()
    some = [i for i, size in enumerate(sizes.tolist()) if (seen.update([size]) or seen[size] <= 2)]
    sets = [(-1, -1)] + [(i, -1) for i in some] + list(combinations(some, 2))
    table = np.array(sets, dtype=np.int64).T
    padded = np.append(sizes, 0)
    return np.vstack([padded[table].sum(axis=0), np.full(len(sets), room - sizes.sum()), table])


def _leaving(sizes: np.ndarray) -> tuple[list[tuple], np.ndarray]:
    seen = Counter()
    some = [i for i, size in enumerate(sizes.tolist()) if (seen.update([size]) or seen[size] <= 2)]
    outs = [(i,) for i in some] + list(combinations(some, 2))
    return outs, np.array([sizes[list(out)].sum() for out in outs], dtype=np.int64)


def _joined(tables: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    every = np.concatenate([t[:2] for t in tables], axis=1)
    return every[0], every[1], np.repeat(np.arange(len(tables)), [t.shape[1] for t in tables])


def _pack(length: int):
    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["_row", "piece"], ignore_index=True)
        lengths = group["length"].to_numpy()
        sequence, offset = np.zeros(len(group), np.int64), np.zeros(len(group), np.int64)
        for b, members in enumerate(swap_search(best_fit(lengths, length), lengths, length)):
            sequence[members] = b
            offset[members] = np.concatenate([[0], np.cumsum(lengths[members])[:-1]])
        return group.assign(sequence_id=sequence + int(group["_block"].iloc[0]) * 2 * BLOCK, offset=offset)
    return pack


def pack_documents(docs: DataFrame, ranks_path: str, pattern: str, length: int = 1024, end_id: int = 2,
                   text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Every document as pieces of at most ``length`` tokens, placed gapless in sequences of ``length``.

    Returns doc_id, piece, start, length, ids_crc32, sequence_id and offset. ``end_id``
    ends each document; documents longer than a sequence are cut, the first piece taking
    what full ones leave over. Pieces are dealt into blocks of about ``BLOCK`` by their
    place in the input, whatever their ids, and a block is packed by one task: best fit,
    then the swap search. A sequence never spans blocks, which costs less than one
    sequence in each.

    A NULL or empty text is its end id alone; equal or NULL ids are separate documents;
    no documents give no pieces.
    """
    pieces = materialise(tokenised_pieces(docs, ranks_path, pattern, length, end_id, text, doc_id))
    blocks = max(1, round(pieces.count() / BLOCK))
    dealt = pieces.withColumn("_block", F.pmod(F.xxhash64("_row", "piece"), F.lit(blocks)))
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in dealt.schema.fields)
    packed = dealt.groupBy("_block").applyInPandas(_pack(length), fields + ", sequence_id long, offset long")
    return packed.select(F.col("_id").alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id",
                         "offset")
