"""Supervised subword embeddings: hashed word and character n-gram vectors, averaged, with a softmax.

The model is trained in numpy on the driver, on a bounded sample. As the average and the softmax's
matrix are both linear, a trained model is applied as one table of class scores per hashed feature:
a text's logits are the mean of the rows of its features, over the whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from .hashing import LOWER, mix, span_hashes, prefix_hashes, text_slices, words

BITS = 17
DIM = 16
GRAMS = (2, 3, 4)
# The driver has little memory: training takes its texts in small pieces.
TRAINING_SLICE = 1 << 17
_AS_IT_IS = np.arange(256, dtype=np.uint8)
# Fixed value: the feature of a word that repeats the word before it.
REPEAT = 0


def _bucket(hashed: np.ndarray, bits: int) -> np.ndarray:
    return (mix(hashed) >> np.uint64(64 - bits)).astype(np.int32)


def features(data: np.ndarray, bounds: np.ndarray, bits: int, keep_case: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Feature sets of a slice: (feature at each place, first place of each text and the end), text by text.

    Words, pairs of neighbouring words (a repeated word is one feature, whatever the word) and byte
    n-grams; none of them crosses from one text into the next.
    """
    data = (_AS_IT_IS if keep_case else LOWER)[data]
    starts, ends, firsts = words(data, bounds)
    if len(starts):
        word = span_hashes(prefix_hashes(data), starts, ends) ^ np.uint64(0xA5A5)
        yield _bucket(word, bits), firsts
        pair = _bucket(word[:-1] * np.uint64(3) + word[1:] * np.uint64(7), bits)
        pair[word[:-1] == word[1:]] = REPEAT
        owner = np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))
        inside = owner[:-1] == owner[1:]
        yield pair[inside], np.searchsorted(owner[:-1][inside], np.arange(len(firsts)))
    wide = data.astype(np.uint64)
    lengths = np.diff(bounds)
    for n in GRAMS:
        if len(data) < n:
            continue
        gram = np.full(len(data) - n + 1, n, np.uint64)
        for k in range(n):
            gram = (gram << np.uint64(8)) | wide[k : len(data) - n + 1 + k]
        first = np.minimum(bounds[:-1], len(gram))
        last = np.minimum(np.maximum(bounds[:-1], bounds[:-1] + lengths - n + 1), len(gram))
        yield _bucket(gram, bits), np.stack([first, last])


def _ranges(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (at[0], at[1]) if at.ndim == 2 else (at[:-1], at[1:])


@dataclass
class Model:
    """A row per class and feature (``table``), ``bias`` and the temperature of the softmax.

    With more classes than a vector has places, ``table`` has the vectors, and ``head`` their softmax's matrix.
    """

    classes: list
    table: np.ndarray
    bias: np.ndarray
    bits: int
    keep_case: bool
    temperature: float = 1.0
    head: np.ndarray | None = None

    def logits(self, column: pa.Array) -> np.ndarray:
        """One row of class logits per text; a text without features has the bias alone."""
        width = len(self.table)
        out = np.zeros((len(column), width))
        for low, high, data, bounds in text_slices(column):
            count = np.zeros(high - low)
            total = np.zeros((high - low, width))
            for feature, at in features(data, bounds, self.bits, self.keep_case):
                first, last = _ranges(at)
                count += last - first
                for c in range(width):
                    sums = np.concatenate(([0.0], np.cumsum(self.table[c][feature], dtype=np.float64)))
                    total[:, c] += sums[last] - sums[first]
            out[low:high] = total / np.maximum(count, 1)[:, None]
        return ((out if self.head is None else out @ self.head.T) + self.bias) / self.temperature

    def probabilities(self, column: pa.Array) -> np.ndarray:
        return softmax(self.logits(column))


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _bags(texts: pa.Array, bits: int, keep_case: bool) -> list[tuple[np.ndarray, np.ndarray]]:
    """(distinct features, their shares) of each text."""
    bags = []
    for low, high, data, bounds in text_slices(texts, TRAINING_SLICE):
        sets = [(f, *_ranges(at)) for f, at in features(data, bounds, bits, keep_case)]
        for i in range(high - low):
            own = [f[first[i] : last[i]] for f, first, last in sets]
            ids, counts = np.unique(np.concatenate(own) if own else np.empty(0, np.int32), return_counts=True)
            bags.append((ids, (counts / max(counts.sum(), 1)).astype(np.float32)))
    return bags


def train(
    texts: pa.Array | pa.ChunkedArray, labels: list, keep_case: bool, epochs: int = 6, rate: float = 2.0, seed: int = 0,
    bits: int = BITS, dim: int = DIM, hold: int = 5,
) -> tuple[Model, np.ndarray, np.ndarray]:
    """Stochastic gradient descent over ``texts``; every ``hold``-th text is kept out and sets the temperature.

    Returns the model, the kept-out texts' class probabilities and their labels' class numbers.
    """
    classes = sorted(set(labels))
    number = {c: i for i, c in enumerate(classes)}
    rng = np.random.default_rng(seed)
    embed = (rng.standard_normal((1 << bits, dim)) * 0.1).astype(np.float32)
    weight = (rng.standard_normal((len(classes), dim)) * 0.5).astype(np.float32)
    bias = np.zeros(len(classes), np.float32)
    bags = _bags(texts, bits, keep_case)
    target = np.array([number[x] for x in labels], np.int64)
    order = rng.permutation(len(bags))
    calibrate, learn = (order[::hold], np.delete(order, np.s_[::hold])) if len(bags) >= 10 * hold else (order, order)
    steps, done = epochs * len(learn), 0
    for _ in range(epochs):
        for i in rng.permutation(learn):
            ids, share = bags[i]
            step = rate * (1 - done / steps)
            done += 1
            hidden = share @ embed[ids]
            z = weight @ hidden + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[target[i]] -= 1
            back = weight.T @ p
            weight -= 0.1 * step * np.outer(p, hidden)
            bias -= 0.02 * step * p
            # The mean spreads the gradient over all features: one step moves the hidden vector by ``step``.
            embed[ids] -= (step / max(float(share @ share), 1e-6)) * share[:, None] * (back * 0.1)
    many = len(classes) > dim
    rows = embed.T if many else (embed @ weight.T).T
    model = Model(classes, np.ascontiguousarray(rows), bias.astype(np.float64), bits, keep_case, head=weight if many else None)
    means = np.array([model.table[:, ids] @ share if len(ids) else np.zeros(len(rows)) for ids, share in (bags[i] for i in calibrate)]).reshape(-1, len(rows))
    logits = (means @ weight.T if many else means) + model.bias
    truth = target[calibrate]
    model.temperature = calibrated_temperature(logits, truth)
    return model, softmax(logits / model.temperature), truth


def calibrated_temperature(logits: np.ndarray, truth: np.ndarray) -> float:
    """The temperature that makes kept-out labels likeliest; one extra miss is assumed, so it never goes to 0."""
    if not len(truth):
        return 1.0
    best, least = 1.0, np.inf
    for t in np.geomspace(0.05, 20, 60):
        p = softmax(logits / t)[np.arange(len(truth)), truth]
        loss = -np.log(p * (1 - 1e-3) + 1e-3 / logits.shape[1]).mean() + 1e-3 * (np.log(t) ** 2)
        if loss < least:
            best, least = float(t), loss
    return best
