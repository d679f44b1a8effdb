"""A linear-chain conditional random field over hashed token features, in numpy batches."""

import zlib
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

import numpy as np

#: Slots for features; each is a weight per label.
SLOTS = 1 << 14
_NEVER = -1e9


def slots(names: Iterable[str]) -> list[int]:
    return [zlib.crc32(name.encode("utf-8", "replace")) % SLOTS for name in names]


@dataclass(frozen=True)
class Chain:
    """``weights`` by slot and label, ``steps`` between labels; ``outside`` is the label around a sequence."""
    weights: np.ndarray
    steps: np.ndarray
    outside: int

    def decode(self, sequences: Sequence[Sequence[Sequence[int]]], batch: int = 256) -> list[np.ndarray]:
        """The likeliest labels of each sequence of tokens' slots (Viterbi, sequences of like length together)."""
        labels: list = [None] * len(sequences)
        order = sorted(range(len(sequences)), key=lambda i: len(sequences[i]))
        for begin in range(0, len(order), batch):
            some = order[begin:begin + batch]
            emit, lengths = _emissions(self.weights, [sequences[i] for i in some])
            best = emit[:, 0] + self.steps[self.outside]
            back = np.zeros((emit.shape[1], len(some), emit.shape[2]), np.int8)
            ends = np.zeros(len(some), np.int64)
            for t in range(1, emit.shape[1] + 1):
                last = lengths == t
                ends[last] = (best[last] + self.steps[:, self.outside]).argmax(axis=1)
                if t < emit.shape[1]:
                    paths = best[:, :, None] + self.steps
                    back[t] = paths.argmax(axis=1)
                    best = paths.max(axis=1) + emit[:, t]
            for row, i in enumerate(some):
                path = np.zeros(lengths[row], np.int64)
                path[-1] = ends[row]
                for t in range(lengths[row] - 1, 0, -1):
                    path[t - 1] = back[t, row, path[t]]
                labels[i] = path
        return labels


def _emissions(weights: np.ndarray, sequences: Sequence) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(s) for s in sequences])
    emit = np.zeros((len(sequences), int(lengths.max()), weights.shape[1]))
    for row, tokens in enumerate(sequences):
        for t, token in enumerate(tokens):
            emit[row, t] = weights[token].sum(axis=0)
    return emit, lengths


def allowed_steps(begins: Sequence[int], insides: Sequence[int], count: int) -> np.ndarray:
    """Zero where a label may follow another: the inside of a kind only follows its begin or itself."""
    steps = np.zeros((count, count))
    for begin, inside in zip(begins, insides):
        others = [i for i in range(count) if i not in (begin, inside)]
        steps[others, inside] = _NEVER
    return steps


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (np.log(np.exp(x - top).sum(axis=axis, keepdims=True)) + top).squeeze(axis)


def train(sequences: Sequence[Sequence[Sequence[int]]], labels: Sequence[Sequence[int]], allowed: np.ndarray,
          outside: int = 0, rounds: int = 120, rate: float = 0.3, decay: float = 0.002) -> Chain:
    """Maximises the labels' likelihood, less ``decay`` times the squared weights, by AdaGrad over all sequences."""
    count = len(allowed)
    weights, steps = np.zeros((SLOTS, count)), np.zeros((count, count))
    seen_w, seen_s = np.full_like(weights, 1e-6), np.full_like(steps, 1e-6)
    lengths = np.array([len(s) for s in sequences])
    rows = np.repeat(np.arange(len(sequences)), lengths)
    times = np.concatenate([np.arange(n) for n in lengths])
    tokens = [slot for s in sequences for slot in s]
    flat = np.concatenate([np.array(t) for t in tokens])
    owner = np.repeat(np.arange(len(tokens)), [len(t) for t in tokens])
    gold = np.concatenate([np.array(y) for y in labels])
    gold_steps = np.zeros((count, count))
    for y in labels:
        path = [outside, *y, outside]
        np.add.at(gold_steps, (path[:-1], path[1:]), 1)
    longest = int(lengths.max())
    for _ in range(rounds):
        scores = np.zeros((len(tokens), count))
        np.add.at(scores, owner, weights[flat])
        emit = np.zeros((len(sequences), longest, count))
        emit[rows, times] = scores
        links = steps + allowed
        ahead = np.zeros_like(emit)
        ahead[:, 0] = emit[:, 0] + links[outside]
        for t in range(1, longest):
            ahead[:, t] = _log_sum(ahead[:, t - 1, :, None] + links, 1) + emit[:, t]
        behind = np.zeros_like(emit)
        behind[:, longest - 1] = links[:, outside]
        for t in range(longest - 2, -1, -1):
            onward = _log_sum(links + (emit[:, t + 1] + behind[:, t + 1])[:, None, :], 2)
            behind[:, t] = np.where((lengths - 1 == t)[:, None], links[:, outside], onward)
        total = _log_sum(ahead[np.arange(len(sequences)), lengths - 1] + links[:, outside], 1)
        chance = np.exp(ahead + behind - total[:, None, None])[rows, times]
        expected = np.zeros((count, count))
        expected[outside] += chance[times == 0].sum(axis=0)
        expected[:, outside] += chance[times == lengths[rows] - 1].sum(axis=0)
        for t in range(longest - 1):
            on = lengths > t + 1
            pair = (ahead[on, t][:, :, None] + links + (emit[on, t + 1] + behind[on, t + 1])[:, None, :]
                    - total[on][:, None, None])
            expected += np.exp(pair).sum(axis=0)
        error = -chance
        error[np.arange(len(gold)), gold] += 1
        grad_w = np.zeros_like(weights)
        np.add.at(grad_w, flat, error[owner])
        grad_w -= decay * len(sequences) * weights
        grad_s = gold_steps - expected - decay * len(sequences) * steps
        seen_w += grad_w ** 2
        seen_s += grad_s ** 2
        weights += rate * grad_w / np.sqrt(seen_w)
        steps += rate * grad_s / np.sqrt(seen_s)
    return Chain(weights, steps + allowed, outside)
