"""A static range asymmetric numeral system for token ids: one frequency table, independent interleaved blocks.

A block has up to ``LANES`` states; id number i belongs to state i mod lanes, so numpy works
on all of them at once. Every ``CHECKPOINT`` ids the states and the place in the code words
are noted, so that decoding may begin there, and the words from one checkpoint to the next
have a checksum of their own.
"""

import struct
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np

#: Frequencies add up to 2 ** SCALE_BITS; more ids than a quarter of that take more bits.
SCALE_BITS, MAX_SCALE_BITS = 20, 30
#: Ids below this are looked up in a list, larger ones searched for.
LISTED = 1 << 22
#: A state lies between 2 ** 31 and 2 ** 63 and gives off 32 bits at a time.
LOWEST = 1 << 31
LANES = 1024
#: Ids between two checkpoints, about.
CHECKPOINT = 1 << 17

_TABLE = struct.Struct("<4sIII")
_TABLE_MAGIC, _MAGIC = b"rTB1", b"rBK1"
#: magic, bytes of the block, lanes, table's checksum, documents, bytes of their list, checkpoints, steps between
#: two of them, code words, ids, ids before the block.
_HEADER = struct.Struct("<4sQIIIIIIQQQ")
_SUM = struct.Struct("<I")


class Damaged(ValueError):
    """Bytes that are not what was written."""


@dataclass(frozen=True)
class Table:
    """The ids that occur, rising, and their frequencies, of which none is zero."""
    ids: np.ndarray
    frequencies: np.ndarray
    bits: int

    @staticmethod
    def of_counts(ids: Sequence[int], counts: Sequence[int]) -> "Table":
        """Frequencies in proportion to the counts; what rounding leaves over goes to the most frequent ids."""
        order = np.argsort(np.asarray(ids, dtype=np.int64), kind="stable")
        ids, counts = np.asarray(ids, dtype=np.int64)[order], [int(counts[i]) for i in order]
        bits = max(SCALE_BITS, (4 * len(ids)).bit_length())
        if bits > MAX_SCALE_BITS:
            raise ValueError("more distinct ids than a table can hold")
        total = max(sum(counts), 1)
        frequencies = np.array([max(1, (c << bits) // total) for c in counts], dtype=np.int64)
        spare = (1 << bits) - int(frequencies.sum()) if len(ids) else 0
        if spare > 0:
            frequencies[np.argmax(frequencies)] += spare
        for i in np.argsort(-frequencies, kind="stable") if spare < 0 else ():
            taken = min(int(frequencies[i]) - 1, -spare)
            frequencies[i] -= taken
            spare += taken
            if spare == 0:
                break
        return Table(ids.astype(np.uint32), frequencies.astype(np.uint64), bits)

    @cached_property
    def starts(self) -> np.ndarray:
        return (np.cumsum(self.frequencies) - self.frequencies).astype(np.uint64)

    @cached_property
    def slots(self) -> np.ndarray:
        """For each of the 2 ** bits slots, which id it belongs to."""
        return np.repeat(np.arange(len(self.ids), dtype=np.uint32), self.frequencies.astype(np.int64))

    @cached_property
    def _places(self) -> np.ndarray:
        """For each number up to the largest id, which id it is, or none."""
        places = np.full(int(self.ids[-1]) + 1, -1, dtype=np.int64)
        places[self.ids] = np.arange(len(self.ids))
        return places

    def symbols(self, ids: np.ndarray) -> np.ndarray:
        """Which of the table's ids each one is; looked up, unless ids are too large for such a list."""
        if not len(ids):
            return np.zeros(0, dtype=np.int64)
        if len(self.ids) and ids.max() <= self.ids[-1]:
            found = self._places[ids] if self.ids[-1] < LISTED else np.searchsorted(self.ids, ids)
            if found.min() >= 0 and not np.any(self.ids[found] != ids):
                return found
        raise ValueError("an id that the table does not know")

    def to_bytes(self) -> bytes:
        body = self.ids.astype("<u4").tobytes() + self.frequencies.astype("<u4").tobytes()
        return _TABLE.pack(_TABLE_MAGIC, self.bits, len(self.ids), zlib.crc32(body)) + body

    @staticmethod
    def from_bytes(data: bytes) -> "Table":
        if len(data) < _TABLE.size:
            raise Damaged("a table without its header")
        magic, bits, size, checksum = _TABLE.unpack_from(data)
        body = data[_TABLE.size:_TABLE.size + 8 * size]
        if magic != _TABLE_MAGIC or len(body) != 8 * size or zlib.crc32(body) != checksum:
            raise Damaged("not the table that was written")
        numbers = np.frombuffer(body, dtype="<u4")
        return Table(numbers[:size].astype(np.uint32), numbers[size:].astype(np.uint64), bits)

    @cached_property
    def checksum(self) -> int:
        return zlib.crc32(self.to_bytes())


def _lanes(count: int) -> int:
    """States for so many ids: a power of two, fewer for short blocks, whose states would outweigh the words."""
    return min(LANES, 1 << max(0, (count // 64).bit_length() - 1))


def encode_block(ids: np.ndarray, table: Table, doc_ids: Sequence[int | None], lengths: Sequence[int],
                 before: int = 0) -> bytes:
    """The ids of some documents as a block: header, documents, checkpoints, code words, each with a checksum."""
    count = len(ids)
    lanes = _lanes(count)
    symbols = table.symbols(ids)
    steps, every = -(-count // lanes), max(1, CHECKPOINT // lanes)
    bits = np.uint64(table.bits)
    room = np.uint64((LOWEST >> table.bits) << 32)
    states = np.full(lanes, LOWEST, dtype=np.uint64)
    frequency, start = table.frequencies[symbols], table.starts[symbols]
    words, noted = [], []
    # The last id goes first, so that reading gives them in order.
    for step in range(steps - 1, -1, -1):
        at = slice(step * lanes, min((step + 1) * lanes, count))
        f, s = frequency[at], start[at]
        x = states[:len(f)]
        full = x >= room * f
        words.append(x[full].astype(np.uint32))
        x = np.where(full, x >> np.uint64(32), x)
        whole = x // f
        states[:len(f)] = (whole << bits) + (x - whole * f) + s
        if step % every == 0:
            noted.append((step, states.copy()))
    words, noted = words[::-1], noted[::-1]
    ends = np.cumsum([0] + [len(w) for w in words])
    stream = np.concatenate(words or [np.zeros(0, np.uint32)]).astype("<u4")

    checkpoints = []
    for number, (step, at_step) in enumerate(noted):
        first = ends[step]
        last = ends[noted[number + 1][0]] if number + 1 < len(noted) else len(stream)
        body = struct.pack("<QI", int(first), zlib.crc32(stream[first:last].tobytes())) + at_step.astype("<u8").tobytes()
        checkpoints.append(body)
    known = np.array([d is not None for d in doc_ids], dtype=np.uint8)
    listed = zlib.compress(known.tobytes() + np.array([d or 0 for d in doc_ids], dtype="<i8").tobytes()
                           + np.array(lengths, dtype="<u8").tobytes(), 1)
    front = listed + b"".join(checkpoints)
    size = _HEADER.size + _SUM.size + len(front) + _SUM.size + 4 * len(stream)
    header = _HEADER.pack(_MAGIC, size, lanes, table.checksum, len(doc_ids), len(listed), len(noted), every,
                          len(stream), count, before)
    return header + _SUM.pack(zlib.crc32(header)) + front + _SUM.pack(zlib.crc32(front)) + stream.tobytes()


class Block:
    """A block as it is read: its documents, and its ids from any checkpoint on."""

    def __init__(self, data: bytes, offset: int = 0):
        at = offset + _HEADER.size
        header = data[offset:at]
        if len(header) < _HEADER.size or data[at:at + 4] != _SUM.pack(zlib.crc32(header)):
            raise Damaged("not the header of a block")
        (magic, self.size, self.lanes, self.table_checksum, documents, listed, self.checkpoints, self.every, self.words,
         self.count, self.before) = _HEADER.unpack(header)
        if magic != _MAGIC or offset + self.size > len(data):
            raise Damaged("a block that is cut off")
        at += _SUM.size
        self._note = 12 + 8 * self.lanes
        front = data[at:at + listed + self.checkpoints * self._note]
        at += len(front)
        if data[at:at + 4] != _SUM.pack(zlib.crc32(front)):
            raise Damaged("documents or checkpoints that are not what was written")
        self._stream = memoryview(data)[at + 4:at + 4 + 4 * self.words]
        self._notes = front[listed:]
        body = zlib.decompress(front[:listed])
        known = np.frombuffer(body, np.uint8, documents)
        numbers = np.frombuffer(body, "<i8", documents, documents)
        self.doc_ids = [int(n) if k else None for n, k in zip(numbers, known)]
        self.lengths = np.frombuffer(body, "<u8", documents, 9 * documents).astype(np.int64)

    def _words_from(self, number: int) -> int:
        if number >= self.checkpoints:
            return self.words
        return struct.unpack_from("<Q", self._notes, number * self._note)[0]

    def segment(self, number: int, table: Table) -> np.ndarray:
        """The ids from one checkpoint to the next, whatever the rest of the block holds."""
        if table.checksum != self.table_checksum:
            raise Damaged("a block that was written with another table")
        at = number * self._note
        first, checksum = struct.unpack_from("<QI", self._notes, at)
        words = np.frombuffer(self._stream[4 * first:4 * self._words_from(number + 1)], "<u4").astype(np.uint64)
        if zlib.crc32(self._stream[4 * first:4 * self._words_from(number + 1)]) != checksum:
            raise Damaged("code words that are not what was written")
        states = np.frombuffer(self._notes, "<u8", self.lanes, at + 12).astype(np.uint64)
        begin = number * self.every * self.lanes
        symbols = np.empty(min(self.every * self.lanes, self.count - begin), dtype=np.uint32)
        bits, mask, used = np.uint64(table.bits), np.uint64((1 << table.bits) - 1), 0
        for place in range(0, len(symbols), self.lanes):
            x = states[:min(self.lanes, len(symbols) - place)]
            slot = x & mask
            found = table.slots[slot]
            x = table.frequencies[found] * (x >> bits) + slot - table.starts[found]
            low = np.flatnonzero(x < LOWEST)
            x[low] = (x[low] << np.uint64(32)) | words[used:used + len(low)]
            used += len(low)
            states[:len(x)] = x
            symbols[place:place + len(x)] = found
        return table.ids[symbols]

    def ids(self, table: Table) -> np.ndarray:
        return np.concatenate([self.segment(n, table) for n in range(self.checkpoints)] or [np.zeros(0, np.uint32)])


def blocks(data: bytes, separator: bytes = b"") -> Iterator[Block]:
    """The blocks of a file, each followed by ``separator``."""
    at = 0
    while at < len(data):
        block = Block(data, at)
        at += block.size
        if data[at:at + len(separator)] != separator:
            raise Damaged("blocks that are not parted as they were")
        at += len(separator)
        yield block
