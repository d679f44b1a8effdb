"""A quality classifier from trusted positives and unlabelled text: non-negative PU learning."""

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..checkpoints import materialise

#: At most so many trusted and so many unlabelled texts are learnt from.
MAX_POSITIVES, MAX_UNLABELLED = 8_000, 24_000

# ----------------------------------------------------------------- what is seen of a text

_SINGLES = ".,!?;:'\"|$#%&*@+-_/\\=<>()[]{}~^"
_LOWER, _UPPER, _DIGIT, _SPACE, _LINE, _BEYOND, _OTHER = range(len(_SINGLES), len(_SINGLES) + 7)
CLASSES = _OTHER + 1


def _class_table() -> np.ndarray:
    table = np.full(256, _OTHER, np.int64)
    for start, end, kind in (("a", "z", _LOWER), ("A", "Z", _UPPER), ("0", "9", _DIGIT)):
        table[ord(start):ord(end) + 1] = kind
    table[128:] = _BEYOND
    table[[9, 32]], table[[10, 11, 12, 13]] = _SPACE, _LINE
    for kind, character in enumerate(_SINGLES):
        table[ord(character)] = kind
    return table


_TABLE = _class_table()
# Pairs of the broad classes; every sign counts as one class there.
_BROAD = np.minimum(np.maximum(np.arange(CLASSES) - len(_SINGLES) + 1, 0), 7)
WIDTH = CLASSES + 64 + 11


def features(text: str | None) -> np.ndarray:
    """Numbers about the form of the whole text: its signs, pairs of signs, words and lines.

    None of them depends on the language or on particular words. An empty text is all zeros.
    """
    raw = (text or "").encode("utf-8", "replace")
    seen = np.zeros(WIDTH, np.float32)
    if not raw:
        return seen
    singles, pairs = np.zeros(CLASSES), np.zeros(64)
    data = np.frombuffer(raw, np.uint8)
    for start in range(0, len(data), 1 << 20):      # a long text takes no more memory
        kinds = _TABLE[data[max(start - 1, 0):start + (1 << 20)]]
        broad = _BROAD[kinds]
        pairs += np.bincount(broad[:-1] * 8 + broad[1:], minlength=64)
        singles += np.bincount(kinds[1 if start else 0:], minlength=CLASSES)
    words, lines = raw.split(), raw.split(b"\n")
    counts = Counter(words)
    n = max(len(words), 1)
    lengths = np.fromiter(map(len, words), np.float64, len(words)) if words else np.zeros(1)
    repeats = sum(map(bytes.__eq__, words, words[1:]))
    couples = len(set(zip(words, words[1:])))
    tops = sorted(counts.values(), reverse=True)[:5] if counts else [0]
    seen[:CLASSES] = np.sqrt(singles / len(data))
    seen[CLASSES:CLASSES + 64] = np.sqrt(pairs / len(data))
    seen[CLASSES + 64:] = (np.log1p(len(data)), np.log1p(len(words)), lengths.mean(), lengths.std(),
                           len(counts) / n, repeats / n, couples / n, tops[0] / n, sum(tops) / n,
                           len(set(lines)) / len(lines), np.log1p(len(lines)) - np.log1p(len(words)))
    return seen


# ------------------------------------------------------------------------------ the model

@dataclass(frozen=True)
class Model:
    """A network of one hidden layer over scaled features; ``score`` gives 0 to 1."""
    mean: np.ndarray
    scale: np.ndarray
    hidden: np.ndarray
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: float
    prior: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        x = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.tanh(x @ self.hidden + self.hidden_bias) @ self.out + self.out_bias

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x), -40, 40)))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit(positives: np.ndarray, unlabelled: np.ndarray, prior: float, hidden: int = 32, rounds: int = 60,
        rate: float = 0.005, decay: float = 1e-4, seed: int = 7) -> Model:
    """Minimises the non-negative unbiased risk with the logistic loss.

    The risk is ``prior * E_p[loss(+)] + max(0, E_u[loss(-)] - prior * E_p[loss(-)])``. When
    the second part falls below zero for a batch, the model has begun to fit the unlabelled
    texts as if none were positive; that batch's step goes up the part instead of down.
    """
    rng = np.random.default_rng(seed)
    every = np.concatenate([positives, unlabelled])
    mean, scale = every.mean(axis=0), every.std(axis=0) + 1e-3
    p, u = (np.clip((x - mean) / scale, -8, 8).astype(np.float64) for x in (positives, unlabelled))
    weights = [rng.normal(0, 1 / np.sqrt(p.shape[1]), (p.shape[1], hidden)), np.zeros(hidden),
               rng.normal(0, 1 / np.sqrt(hidden), hidden), np.zeros(1)]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    batches = max(1, len(u) // 512)
    step = 0
    for _ in range(rounds):
        p_order, u_order = rng.permutation(len(p)), rng.permutation(len(u))
        for pb, ub in zip(np.array_split(p_order, batches), np.array_split(u_order, batches)):
            if not len(pb):
                pb = p_order
            x = np.concatenate([p[pb], u[ub]])
            h = np.tanh(x @ weights[0] + weights[1])
            z = h @ weights[2] + weights[3][0]
            zp, zu = z[:len(pb)], z[len(pb):]
            negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
            down_p, down_u = -prior * _sigmoid(zp) / len(zp), _sigmoid(zu) / len(zu)
            if negative >= 0:
                dz = np.concatenate([-prior * _sigmoid(-zp) / len(zp) + down_p, down_u])
            else:
                dz = np.concatenate([-down_p, -down_u])
            dh = np.outer(dz, weights[2]) * (1 - h ** 2)
            grads = [x.T @ dh + decay * weights[0], dh.sum(axis=0), h.T @ dz + decay * weights[2],
                     np.array([dz.sum()])]
            step += 1
            for w, g, m, v in zip(weights, grads, first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g ** 2 - v)
                w -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return Model(mean, scale, weights[0], weights[1], weights[2], float(weights[3][0]), prior)


def estimate_prior(positives: np.ndarray, unlabelled: np.ndarray, seed: int = 7) -> float:
    """The share of positives among the unlabelled.

    A model is fitted to tell half of the positives from half of the unlabelled. In the
    other halves, the share of the unlabelled above a threshold is at least the prior times
    the share of positives above it, with equality where no negatives are; so the prior is
    the least ratio of the two over all thresholds, each with a margin for its sample.
    """
    rng = np.random.default_rng(seed)
    p, u = rng.permutation(positives), rng.permutation(unlabelled)
    if len(p) < 4 or len(u) < 4:
        return 0.5
    model = fit(p[::2], u[::2], 0.5, rounds=15)
    ps, us = np.sort(model.logits(p[1::2])), np.sort(model.logits(u[1::2]))
    above_p = 1 - np.arange(len(ps)) / len(ps)
    above_u = 1 - np.searchsorted(us, ps) / len(us)
    margin = np.sqrt(np.log(20) / 2) * (1 / np.sqrt(len(ps)) + 1 / np.sqrt(len(us)))
    best = np.argmin((above_u + margin) / above_p)
    return float(np.clip(above_u[best] / above_p[best], 0.05, 0.95))


def train(positives: np.ndarray, unlabelled: np.ndarray) -> Model:
    return fit(positives, unlabelled, estimate_prior(positives, unlabelled))


# ------------------------------------------------------------------------------- on Spark

def held_out(doc_id: str) -> Column:
    """Rows whose labels are never learnt from: a quarter, by the CRC of the id as text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 4 == 2


def _samples(docs: DataFrame, labels: DataFrame, text: str, doc_id: str) -> tuple[np.ndarray, np.ndarray]:
    """Features of trusted positives and of unlabelled texts, each a bounded sample by the hash of the id."""
    def sampled(n: int, bound: int) -> Column:
        return F.pmod(F.xxhash64(F.col(doc_id)), F.lit(1 << 31)) < int((1 << 31) * min(1.0, 1.2 * bound / max(n, 1)))

    trusted = (labels.select(F.col("doc_id").alias(doc_id), "quality").filter(~held_out(doc_id))
               .groupBy(doc_id).agg(F.min("quality").alias("least")).filter("least = 1").select(doc_id))
    n_trusted = trusted.count()
    # Some 1.2 times MAX_POSITIVES ids at most.
    ids = trusted.filter(sampled(n_trusted, MAX_POSITIVES)).select(F.col(doc_id).alias("_trusted"))
    rows = (docs.select(F.col(doc_id).alias(doc_id), F.col(text).alias("_text")).filter(~held_out(doc_id))
            .join(F.broadcast(ids), F.col(doc_id) == F.col("_trusted"), "left")
            .select("_text", F.col("_trusted").isNotNull().alias("_positive"),
                    sampled(docs.count(), MAX_UNLABELLED).alias("_unlabelled"),
                    F.xxhash64(F.col(doc_id), "_text").alias("_order")).filter("_positive OR _unlabelled"))

    def seen(batches):
        for batch in batches:
            yield pd.DataFrame({"_positive": batch["_positive"], "_unlabelled": batch["_unlabelled"],
                                "_order": batch["_order"], "_features": [features(t) for t in batch["_text"]]})

    table = materialise(rows.mapInPandas(
        seen, "_positive boolean, _unlabelled boolean, _order long, _features array<float>"))

    def drawn(flag: str, bound: int) -> np.ndarray:
        some = table.filter(flag).orderBy("_order").limit(bound).select("_features").toPandas()
        return np.array(some["_features"].tolist(), np.float32).reshape(-1, WIDTH)

    return drawn("_positive", MAX_POSITIVES), drawn("_unlabelled", MAX_UNLABELLED)


def learn(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id") -> Model | None:
    """A model of the texts that ``labels`` (doc_id, quality) trusts, against all texts; None without any trusted.

    An id labelled both ways is not trusted. Held-out rows are in neither sample.
    """
    positives, unlabelled = _samples(docs, labels, text, doc_id)
    return train(positives, unlabelled) if len(positives) else None


def score(text: Column, model: Model | None) -> Column:
    """From 0 to 1, higher where the text is likelier to be good; 0.5 where nothing could be learnt."""
    if model is None:
        return F.lit(0.5).cast("double")

    @F.pandas_udf(T.DoubleType())
    def scored(texts: pd.Series) -> pd.Series:
        if not len(texts):
            return pd.Series([], dtype=float)
        return pd.Series(model.score(np.array([features(t) for t in texts], np.float32)), dtype=float)
    return scored(text)


def scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, text: str = "text",
           doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``.

    A NULL text is scored as an empty one, and a NULL id is not held out. Equal texts have
    equal scores; an empty table gives no rows.
    """
    model = learn(docs, labels, text, doc_id)
    scored = docs.select(F.col(doc_id).alias("doc_id"), held_out(doc_id).alias("held_out"),
                         score(F.col(text), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, text: str = "text",
              doc_id: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that score ``threshold`` or more; all of them where nothing could be learnt."""
    model = learn(docs, labels, text, doc_id)
    return docs if model is None else docs.filter(score(F.col(text), model) >= threshold)
