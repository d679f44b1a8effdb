"""The expectation maximisation of MLlib's topic model, with texts that stay where they are.

MLlib keeps a graph of texts and terms, whose edges it goes through in a fixed number of tasks
and whose nodes it sends about in every iteration. Here a text is a row: its terms, their counts
and its topics. An iteration reads the rows once, with the weights of all terms at hand, and what
leaves a task is a row per term. Start, formulas and order of the random draws are MLlib's, so the
topics are as well, up to the rounding of sums. Predictions (``predicted``) are those of MLlib's
model, made for many texts at once.

The lists of a text are kept as bytes, so that Spark moves them whole and not number by number.
"""

from collections.abc import Callable, Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.clustering import LocalLDAModel
from pyspark.mllib.common import _py2java
from pyspark.mllib.linalg import Matrices, Vectors
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..checkpoints import checkpoint_dir, remove

#: Terms of texts that are worked on at once, and texts in a file, which a task may read alone.
AT_ONCE, ROWS_PER_FILE = 1 << 15, 1 << 14
#: Terms of texts of about one length whose topics are predicted together: what stays in a core's cache.
TOGETHER, LONGER = 1 << 14, 1.15
#: What MLlib takes for a term's topics if nothing is asked for; for a text's see ``topic_model``.
TERM_CONCENTRATION = 1.1
#: Shape of the draws that predictions start from.
GAMMA_SHAPE = 100.0
# Where predictions end: by so much, on average, a topic's part of a text may still change.
LEAST_CHANGE = 1e-3
# A text's terms, their counts and the counts of its topics, as bytes; or one term's counts of each topic, summed in a task.
_ROWS = "at binary, n binary, topics binary, slot int, weights array<double>"


class JavaDraws:
    """What ``java.util.Random`` draws for a seed, so many numbers a row and many rows at once."""

    _STEP, _SHIFT, _MASK = 0x5DEECE66D, 0xB, (1 << 48) - 1

    def __init__(self, seed: int, width: int):
        self._width, self._state = width, (seed ^ self._STEP) & self._MASK
        # What takes a state over the draws of so many rows, two steps a number: factors and summands.
        factor, summand = 1, 0
        for _ in range(2 * width):
            factor, summand = factor * self._STEP & self._MASK, (summand * self._STEP + self._SHIFT) & self._MASK
        self._factors, self._summands = np.ones(1, np.uint64), np.zeros(1, np.uint64)
        while len(self._factors) <= AT_ONCE:
            self._factors, self._summands = (np.append(self._factors, self._factors * np.uint64(factor)),
                                             np.append(self._summands, self._summands * np.uint64(factor) + np.uint64(summand)))
            factor, summand = factor * factor & self._MASK, (summand * factor + summand) & self._MASK

    def rows(self, count: int) -> np.ndarray:
        """The next ``width`` x ``count`` numbers, a column for each row."""
        return np.concatenate([self._some(min(AT_ONCE, count - at)) for at in range(0, count, AT_ONCE)], axis=1)

    def _some(self, count: int) -> np.ndarray:
        begin = np.full(1, self._state, np.uint64)
        states = (self._factors[:count + 1] * begin + self._summands[:count + 1]) & np.uint64(self._MASK)
        self._state, states = int(states[count]), states[:count]
        drawn = np.empty((self._width, count))
        for row in drawn:
            halves = []
            for bits in (26, 27):
                states = (states * np.uint64(self._STEP) + np.uint64(self._SHIFT)) & np.uint64(self._MASK)
                halves.append(states >> np.uint64(48 - bits))
            row[:] = ((halves[0] << np.uint64(27)) + halves[1]).astype(np.float64) * 2.0 ** -53
        return drawn


def _cut(ends: np.ndarray) -> Iterator[tuple[int, int]]:
    """First and last row of pieces of up to AT_ONCE elements, a longer row alone."""
    begin = 0
    while begin < len(ends) - 1:
        end = max(begin + 1, int(np.searchsorted(ends, ends[begin] + AT_ONCE, "right")) - 1)
        yield begin, end
        begin = end


def _lists(values: np.ndarray, ends: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, kind))


def _bytes(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The values from each end to the next as bytes."""
    values = np.ascontiguousarray(values)
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer((ends * values.itemsize).astype(np.int32)),
                                                              pa.py_buffer(values)])


def _numbers(column: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """What ``_bytes`` made: all values, and where each row's end."""
    _, ends, data = column.buffers()
    ends = np.frombuffer(ends, np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    size = np.dtype(kind).itemsize
    values = np.frombuffer(data, np.uint8)[ends[0]:ends[-1]] if data is not None else np.zeros(0, np.uint8)
    return np.frombuffer(values.tobytes(), kind), (ends - ends[0]) // size


def _term(slots: int) -> type:
    """The kind of number that a term is kept as."""
    return np.uint16 if slots <= 1 << 16 else np.int32


class _Task:
    """Rows that a task puts out, and what it has counted of each term."""

    def __init__(self, k: int, slots: int):
        self._k, self._slots, self._counted = k, slots, np.zeros((k, slots))

    def texts(self, at: np.ndarray, n: np.ndarray, ends: np.ndarray, shares: np.ndarray) -> pa.RecordBatch:
        """Texts whose every term, counted, is dealt to topics by a row of ``shares``."""
        at, shares, rows = at.astype(np.intp), np.ascontiguousarray(shares.T), len(ends) - 1
        for counted, some in zip(self._counted, shares):
            counted += np.bincount(at, weights=some, minlength=self._slots)
        topics = np.add.reduceat(shares, ends[:-1], axis=1).T
        return self._batch(rows, at=_bytes(at.astype(_term(self._slots)), ends), n=_bytes(n.astype(np.int32), ends),
                           topics=_bytes(topics, np.arange(rows + 1) * self._k))

    def terms(self) -> pa.RecordBatch:
        met = np.flatnonzero(self._counted.any(axis=0))
        return self._batch(len(met), slot=pa.array(met, pa.int32()), weights=_lists(
            self._counted[:, met].T.ravel(), np.arange(len(met) + 1) * self._k, pa.float64()))

    @staticmethod
    def _batch(rows: int, **columns: pa.Array) -> pa.RecordBatch:
        kinds = {"at": pa.binary(), "n": pa.binary(), "topics": pa.binary(), "slot": pa.int32(),
                 "weights": pa.list_(pa.float64())}
        return pa.RecordBatch.from_pydict({c: columns.get(c, pa.nulls(rows, kind)) for c, kind in kinds.items()})


def _counted_words(column: pa.Array, slots: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The distinct terms of each list of words, their counts and where each list ends, some lists at once."""
    words, ends = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy().astype(np.int64)
    for begin, end in _cut(ends):
        text = np.repeat(np.arange(end - begin), np.diff(ends[begin:end + 1]))
        pairs, n = np.unique(text * slots + words[ends[begin]:ends[end]], return_counts=True)
        yield pairs % slots, n, np.searchsorted(pairs, np.arange(end - begin + 1) * slots)


def _started(k: int, slots: int, seed: int) -> Callable:
    """Every distinct term of a text is dealt to topics at random, by draws that go on from text to text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, draws = _Task(k, slots), JavaDraws(TaskContext.get().partitionId() + seed, k)
        for batch in batches:
            for at, n, ends in _counted_words(batch.column("words"), slots):
                shares = draws.rows(len(at))
                shares *= n / shares.sum(axis=0)
                yield task.texts(at, n, ends, shares.T)
        yield task.terms()

    return run


def _moved(weights: np.ndarray, text_concentration: float) -> Callable:
    """One iteration: terms are dealt anew by the topics of their text and the weights that terms have."""
    k, slots = weights.shape
    less = TERM_CONCENTRATION - 1
    given = np.ascontiguousarray(((weights + less) / (weights.sum(axis=1, keepdims=True) + slots * less)).T)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, every = _Task(k, slots), np.ones(k)
        for batch in batches:
            (at, ends), (n, _), (topics, _) = (_numbers(batch.column(c), kind) for c, kind in (
                ("at", _term(slots)), ("n", np.int32), ("topics", np.float64)))
            topics = topics.reshape(-1, k) + (text_concentration - 1)
            for begin, end in _cut(ends):
                low, high = ends[begin], ends[end]
                shares = np.take(given, at[low:high], axis=0)
                shares *= np.repeat(topics[begin:end], np.diff(ends[begin:end + 1]), axis=0)
                shares *= (n[low:high] / (shares @ every))[:, None]
                yield task.texts(at[low:high], n[low:high], ends[begin:end + 1] - low, shares)
        yield task.terms()

    return run


def term_weights(texts: DataFrame, k: int, max_iter: int, slots: int, partitions: int, seed: int, key: str,
                 words: str) -> np.ndarray:
    """How many of the words in each slot (columns) go to each topic (rows) after ``max_iter`` iterations.

    ``words`` holds the slot of every word of a text. The start is drawn in ``partitions``
    partitions by ``key``, in its order; later passes take files as they come. Each pass is
    written before the one that it was made of is removed. The driver gets the weights alone.
    """
    spark, folder = texts.sparkSession, f"{checkpoint_dir(texts.sparkSession)}/topics-{uuid4().hex}"

    def passed(rows: DataFrame, work: Callable, turn: int) -> DataFrame:
        rows.mapInArrow(work, _ROWS).write.option("maxRecordsPerFile", ROWS_PER_FILE).parquet(f"{folder}/{turn}")
        return spark.read.schema(_ROWS).parquet(f"{folder}/{turn}")

    def summed(rows: DataFrame) -> np.ndarray:
        sums = rows.filter("slot IS NOT NULL").groupBy("slot").agg(
            F.array(*[F.sum(F.col("weights")[topic]) for topic in range(k)]).alias("weights")).toArrow()
        weights = np.zeros((k, slots))
        if sums.num_rows:
            column = sums.column("weights").combine_chunks()
            weights[:, sums.column("slot").to_numpy()] = column.flatten().to_numpy().reshape(-1, k).T
        return weights

    try:
        # Texts of one key come in the order of their words, so that those that differ come as they did.
        dealt = texts.select(key, F.col(words).alias("words")).filter(F.size("words") > 0).repartition(partitions, key)
        rows = passed(dealt.sortWithinPartitions(key, "words").select("words"), _started(k, slots, seed), 0)
        weights = summed(rows)
        for turn in range(1, max_iter + 1):
            rows = passed(rows.filter("slot IS NULL").select("at", "n", "topics"), _moved(weights, 50 / k + 1), turn)
            weights = summed(rows)
            remove(spark, f"{folder}/{turn - 1}")
        return weights
    finally:
        remove(spark, folder)


def topic_model(texts: DataFrame, k: int, max_iter: int, slots: int, partitions: int, seed: int, key: str,
                words: str) -> LocalLDAModel:
    """MLlib's model of the weights that ``term_weights`` finds, for vectors of ``slots`` counts in ``features``.

    A text's topics have the concentration 50 / k + 1, a term's TERM_CONCENTRATION, as MLlib takes them.
    """
    if k < 2:
        raise ValueError("a topic model has two topics or more")
    weights = term_weights(texts, k, max_iter, slots, partitions, seed, key, words)
    context = texts.sparkSession.sparkContext
    library = context._jvm.org.apache.spark
    local = library.mllib.clustering.LocalLDAModel(
        _py2java(context, Matrices.dense(slots, k, weights.ravel())), _py2java(context, Vectors.dense([50 / k + 1] * k)),
        TERM_CONCENTRATION, GAMMA_SHAPE).setSeed(seed)
    model = LocalLDAModel(library.ml.clustering.LocalLDAModel(
        f"lda_{uuid4().hex[:12]}", slots, local, texts.sparkSession._jsparkSession))
    return model._set(k=k, maxIter=max_iter, seed=seed, optimizer="em", featuresCol="features",
                      topicDistributionCol="topic_weights")


def digamma(x: np.ndarray) -> np.ndarray:
    """The logarithmic derivative of the gamma function for numbers of zero or more."""
    x, less = np.array(x, np.float64), np.zeros(np.shape(x))
    with np.errstate(divide="ignore", over="ignore"):
        while (low := x < 6).any():
            less[low] += 1 / x[low]
            x[low] += 1
        s = 1 / (x * x)
        series = s * (1 / 12 - s * (1 / 120 - s * (1 / 252 - s * (1 / 240 - s * (1 / 132 - s * (691 / 32760 - s * (
            1 / 12 - s * 3617 / 8160)))))))
        return np.log(x) - 0.5 / x - series - less


def first_topics(spark: SparkSession, k: int, seed: int) -> np.ndarray:
    """The draws that MLlib's model starts from, for every text the same."""
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    # A long seed as its two halves: a small number alone would be taken for an int, which is another seed.
    halves = gateway.new_array(jvm.int, 2)
    halves[0], halves[1] = (int(half) for half in np.array([seed], ">i8").view(">i4"))
    basis = jvm.breeze.stats.distributions.RandBasis(jvm.org.apache.commons.math3.random.MersenneTwister(halves))
    draws = jvm.breeze.stats.distributions.Gamma(GAMMA_SHAPE, 1 / GAMMA_SHAPE, basis)
    return np.array([draws.draw() for _ in range(k)])


def _inferred(at: np.ndarray, n: np.ndarray, ends: np.ndarray, given: np.ndarray, first: np.ndarray,
              concentration: float) -> np.ndarray:
    """The topics' shares of each text, a row for each: zero for texts without words."""
    lengths, found = np.diff(ends), np.zeros((len(ends) - 1, len(first)))
    order = np.argsort(lengths, kind="stable")
    order = order[lengths[order] > 0]
    rising = lengths[order]
    begin = 0
    while begin < len(order):
        end = int(np.searchsorted(rising, rising[begin] * LONGER, "right"))
        end = min(end, max(begin + 1, begin + TOGETHER // int(rising[end - 1])))
        some, longest = order[begin:end], int(rising[end - 1])
        # Texts are as long as the longest of them: what is beyond their end has a count of 0.
        inside = np.arange(longest) < lengths[some][:, None]
        place = np.where(inside, ends[some][:, None] + np.arange(longest), 0)
        terms = np.ascontiguousarray(np.take(given, at[place], axis=0).transpose(0, 2, 1))
        found[some] = _rounds(terms, np.where(inside, n[place], 0.0), first, concentration)
        begin = end
    return found


def _rounds(terms: np.ndarray, n: np.ndarray, first: np.ndarray, concentration: float) -> np.ndarray:
    """Each text is gone over until its topics hardly change, and soon left out of the rounds that others need.

    The expectation of a topic's logarithm is taken without what all topics of the text have in
    common: that falls out when a term is dealt to topics.
    """
    k, found = len(first), np.empty((len(n), len(first)))
    live, done = np.arange(len(n)), np.zeros(len(n), bool)
    topics = np.tile(first, (len(n), 1))
    while not done.all():
        weighed = np.exp(digamma(topics))
        norm = np.matmul(weighed[:, None, :], terms)[:, 0, :]
        norm += 1e-100
        np.divide(n, norm, out=norm)
        last, topics = topics, weighed * np.matmul(terms, norm[:, :, None])[:, :, 0] + concentration
        # As in the library, where what is not a number ends the rounds.
        ended = ~(np.abs(topics - last).sum(axis=1) > LEAST_CHANGE * k) & ~done
        found[live[ended]] = topics[ended] / topics[ended].sum(axis=1, keepdims=True)
        done |= ended
        if 4 * done.sum() > len(done):
            terms, n, topics, live, done = (x[~done] for x in (terms, n, topics, live, done))
    return found


def predicted(texts: DataFrame, model: LocalLDAModel, words: str, out: str) -> DataFrame:
    """``texts`` with ``out`` in place of ``words``: the shares that MLlib's ``model`` finds for the topics of each text.

    ``words`` holds the slot of every word of a text. NULL and empty lists have shares of zero.
    """
    spark = texts.sparkSession
    weights = model.topicsMatrix().toArray()
    slots, k = weights.shape
    concentration = 50 / k + 1
    shared = spark.sparkContext.broadcast((np.exp(digamma(weights) - digamma(weights.sum(axis=0))),
                                           first_topics(spark, k, model._java_obj.oldLocalModel().seed())))
    kept = [c for c in texts.columns if c != words]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given, first = shared.value
        for batch in batches:
            pieces = list(_counted_words(batch.column(words).fill_null([]), slots))
            at, n, lengths = (np.concatenate([np.zeros(0, np.int64), *some]) for some in (
                [p[0] for p in pieces], [p[1] for p in pieces], [np.diff(p[2]) for p in pieces]))
            found = _inferred(at, n, np.concatenate([[0], np.cumsum(lengths)]), given, first, concentration)
            yield pa.RecordBatch.from_arrays(
                [*map(batch.column, kept), _lists(found.ravel(), np.arange(len(found) + 1) * k, pa.float64())],
                names=[*kept, out])

    schema = T.StructType([*(texts.schema[c] for c in kept), T.StructField(out, T.ArrayType(T.DoubleType()))])
    return texts.select(*kept, words).mapInArrow(run, schema)
