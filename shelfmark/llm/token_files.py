"""Token ids of documents as compressed binary files that are decoded in parallel.

A folder holds a ``table`` of frequencies over all documents and ``blocks``: files of
blocks in ascending order of the documents, as ``rans`` lays them out. Spark writes and
reads the files, so they may lie wherever Spark's file systems reach, and a task that is
run again replaces what it wrote.
"""

import os
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from string import ascii_uppercase

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..checkpoints import pin_partitions
from . import rans

#: A block ends with the document that fills it to so many ids.
BLOCK_IDS = 1 << 18
#: Blocks of one file, which is read by one task: some 25 MB.
BLOCKS_PER_FILE = 64
#: What the writer puts after each block.
PARTED = b"\n"
#: Words whose ids a worker keeps, and the longest of them.
KEPT_WORDS, KEPT_LENGTH = 1_000_000, 48
# No id goes across white space, nor from a letter to the sign after it. So a word of letters and
# the signs that end it are taken apart, but only these: an apostrophe or a combining mark may join,
# and a special id of the vocabulary may be written in angle brackets and bars.
_ENDED = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:;=?@\[-`{}~]+)")

_PLAIN = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
#: The letters that ``_PLAIN`` holds.
LETTERS = "".join(c for c in map(chr, range(256)) if _PLAIN.match(c))


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    """The vocabulary, read once in each worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"      # Spark has a task for every core
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=2)
def _words(path: str) -> "Words":
    """One for all tasks of a worker."""
    return Words(path)


class Words(dict):
    """Ids of texts, word by word, for vocabularies that drop white space: a word that was met keeps its ids.

    Words and ids are bytes, the latter of 32 bits each.
    """

    def __init__(self, path: str):
        super().__init__()
        self._tokenizer = _tokenizer(path)
        self._model = self._tokenizer.model
        self._letters = self._as_the_model_sees()
        self._cases_alike = self._letters is not None and all(
            self._letters[ord(c)] == self._letters[ord(c.lower())] for c in ascii_uppercase)

    def _as_the_model_sees(self) -> dict[int, str] | None:
        """What each letter becomes before the model, if all that happens to a run of them happens letter by letter."""
        normal, parted = self._tokenizer.normalizer, self._tokenizer.pre_tokenizer
        if normal is None or parted is None:
            return None
        seen = {c: [piece for piece, _ in parted.pre_tokenize_str(normal.normalize_str(c))] for c in LETTERS}
        together = [piece for piece, _ in parted.pre_tokenize_str(normal.normalize_str(LETTERS))]
        return {ord(c): seen[c][0] for c in LETTERS} if together == ["".join(map("".join, seen.values()))] else None

    def _kept(self, word: bytes, ids: bytes) -> bytes:
        if len(word) <= KEPT_LENGTH:
            if len(self) >= KEPT_WORDS:
                self.clear()
            self[word] = ids
        return ids

    def __missing__(self, word: bytes) -> bytes:
        if self._cases_alike and word.isalpha() and not word.islower():
            return self._kept(word, self[word.lower()])
        text = word.decode()
        if self._letters and _PLAIN.fullmatch(text):
            return self._kept(word, array("I", [t.id for t in self._model.tokenize(text.translate(self._letters))]).tobytes())
        if ended := _ENDED.fullmatch(text):
            letters, signs = (part.encode() for part in ended.groups())
            # With its signs a word is kept once it is met again, as most are not.
            known, ids = letters in self, self[letters] + self[signs]
            return self._kept(word, ids) if known else ids
        return self._kept(word, array("I", self._tokenizer.encode(text, add_special_tokens=False).ids).tobytes())

    def encode(self, text: str) -> np.ndarray:
        # Bytes are parted at the white space of ASCII alone, as words are.
        return np.frombuffer(b"".join(map(self.__getitem__, text.encode().split())), dtype=np.uint32)


def _in_blocks(batches: Iterator[pd.DataFrame], path: str, end_id: int, block_ids: int) -> Iterator[pd.DataFrame]:
    """The documents of a task as blocks of ids, with the number of ids before each in the task."""
    part, words, before = TaskContext.get().partitionId(), _words(path), 0
    doc_ids, parts, held = [], [], 0

    def block() -> pd.DataFrame:
        ids = np.concatenate(parts)
        # Two bytes an id while it lasts, as these rows are kept until the table is known.
        kept = ids.astype("<u2" if ids.max() < 1 << 16 else "<u4").tobytes()
        return pd.DataFrame({"part": [part], "before": [before], "doc_ids": [doc_ids], "lengths": [[len(p) for p in parts]],
                             "ids": [kept], "n": [held]})

    for batch in batches:
        for doc_id, text in zip(batch["doc_id"], batch["text"]):
            ids = np.append(words.encode(text), np.uint32(end_id))
            doc_ids.append(None if doc_id is None else int(doc_id))
            parts.append(ids)
            held += len(ids)
            if held >= block_ids:
                yield block()
                doc_ids, parts, before, held = [], [], before + held, 0
    if parts:
        yield block()


def _unpacked(ids: bytes, count: int) -> np.ndarray:
    return np.frombuffer(ids, "<u2" if len(ids) == 2 * count else "<u4")


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """How often each id occurs in a task."""
    total = np.zeros(0, dtype=np.int64)
    for batch in batches:
        for ids, count in zip(batch["ids"], batch["n"]):
            some = np.bincount(_unpacked(ids, count))
            if len(some) > len(total):
                some, total = total, some.astype(np.int64)
            total[:len(some)] += some
    met = np.flatnonzero(total)
    yield pd.DataFrame({"id": met, "n": total[met]})


def write_tokens(docs: DataFrame, path: str, vocabulary: str, end_id: int, text: str = "text", doc_id: str = "doc_id",
                 block_ids: int = BLOCK_IDS) -> None:
    """The ids of every whole text and ``end_id`` after it, by ascending id, as files under ``path``.

    The vocabulary is a file of the tokenizers library, read by every worker; it must drop
    white space and take no id across it, so that words can be encoded one by one.

    Texts move once, to be sorted by range of ids; ids repeated or NULL, which come first,
    go by the hash of their text and the order of the input, so they spread over tasks as
    others do. Blocks are cut where they are sorted and checkpointed there; the counts of
    the ids, combined in each task, make the table, which is bounded by the vocabulary.
    Totals of the tasks, one row each, number the ids of all documents. A block holds
    whole documents, a longer one than ``block_ids`` alone.

    A NULL text counts as empty and has the end id alone. No rows, no blocks: the table
    is then empty. Ids are long integers. Other columns are not read.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"),
                       F.xxhash64(text).alias("hash"), F.monotonically_increasing_id().alias("input"))
    order = ["doc_id", "hash", "input"]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).selectExpr(
        # Ids as text keep NULL apart from numbers in pandas.
        "string(doc_id) AS doc_id", "text")
    made = pin_partitions(ordered.mapInPandas(
        lambda batches: _in_blocks(batches, vocabulary, end_id, block_ids),
        "part int, before long, doc_ids array<long>, lengths array<long>, ids binary, n long"))

    counts = made.select("ids", "n").mapInPandas(_counted, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    table = rans.Table.of_counts([r["id"] for r in counts], [r["n"] for r in counts])
    totals = made.groupBy("part").agg(F.sum("n").alias("all"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per task of the range partitioning, whatever the number of documents.
    offsets = totals.select("part", F.coalesce(F.sum("all").over(earlier), F.lit(0)).alias("offset"))

    def encoded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                known = [None if i is None else int(i) for i in row.doc_ids]
                yield pd.DataFrame({"block": [rans.encode_block(_unpacked(row.ids, row.n), table, known, row.lengths,
                                                                row.start)]})

    placed = made.join(F.broadcast(offsets), "part").select(
        # NULL ids go as an array of text for the same reason.
        F.col("doc_ids").cast("array<string>").alias("doc_ids"), "lengths", "ids", "n",
        (F.col("before") + F.col("offset")).alias("start"))
    spark = docs.sparkSession
    # The text writer puts the bytes of a column down as they are, and the separator after each.
    (placed.mapInPandas(encoded, "block binary").select(F.col("block").cast("string"))
     .write.option("maxRecordsPerFile", BLOCKS_PER_FILE).option("lineSep", PARTED.decode()).text(f"{path}/blocks"))
    (spark.createDataFrame([(bytearray(table.to_bytes()),)], "table binary").select(F.col("table").cast("string"))
     .write.option("lineSep", PARTED.decode()).text(f"{path}/table"))


def read_table(spark: SparkSession, path: str) -> rans.Table:
    stored = spark.read.format("binaryFile").load(f"{path}/table").filter("length > 0").select("content").first()
    if stored is None:
        raise rans.Damaged(f"no table in {path}")
    return rans.Table.from_bytes(bytes(stored["content"]))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, ids) of every document that ``write_tokens`` put under ``path``.

    ``start`` counts the ids of all documents before it, ``ids`` holds little-endian
    unsigned 32-bit integers. Files are decoded independently of each other; bytes that
    are not what was written fail by their checksums.
    """
    table = read_table(spark, path)

    def decoded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                for block in rans.blocks(bytes(content), PARTED):
                    ids = block.ids(table).astype("<u4")
                    ends = np.cumsum(block.lengths)
                    yield pd.DataFrame({
                        "doc_id": pd.array(block.doc_ids, dtype="Int64"), "start": block.before + ends - block.lengths,
                        "ids": [ids[end - length:end].tobytes() for end, length in zip(ends, block.lengths)]})

    files = spark.read.format("binaryFile").load(f"{path}/blocks").filter("length > 0").select("content")
    return files.mapInPandas(decoded, "doc_id long, start long, ids binary")
