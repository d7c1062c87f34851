"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment of words.

Words are runs without blanks and ASCII punctuation, A-Z in lower case. All n-grams of an item are
its seeds: which of them an edited copy keeps is not known beforehand, and the rarest are those
that edits destroyed. Where a document holds a seed, the passage around it is aligned with the
item, so edited and paraphrased copies score by what is left of the item. A passage that holds too
few of the item's words for any alignment to pass is left out before: items with a common stem meet
in every document with that stem, and few of them are in it. A copy that keeps no
``GRAM`` successive words of its item has no seed and is not found. Every document is read where it
lies; only benchmark data travel, in slices of bounded size, each slice with a pass of its own over
the documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .hashing import BLANK, mix, portions, shingles, text_slices, word_hashes, words

GRAM = 3
MATCH, MISMATCH, GAP = 1.0, -0.5, -0.5
THRESHOLD = 0.5
SLICE_BYTES = 4 << 20
CELLS_AT_ONCE = 4 << 20
HITS_AT_ONCE = 1 << 20

BETWEEN = BLANK.copy()
BETWEEN[list(range(0x21, 0x30)) + list(range(0x3A, 0x41)) + list(range(0x5B, 0x61)) + list(range(0x7B, 0x7F))] = True
_MASK_BITS = 20


class Items:
    """A slice of the benchmark: words of each item, and its n-grams in order of their hash."""

    def __init__(self, rows: list):
        texts = pa.array([r["text"] or "" for r in rows], pa.large_string())
        self.ids = [r["item_id"] for r in rows]
        hashes, grams, owners, places = [], [], [], []
        for low, _, data, bounds in text_slices(texts):
            starts, ends, firsts = words(data, bounds, BETWEEN)
            word = word_hashes(data, starts, ends)
            gram, at = shingles(word, firsts, GRAM)
            hashes += [word[firsts[i] : firsts[i + 1]] for i in range(len(firsts) - 1)]
            grams.append(gram)
            owners.append(np.repeat(low + np.arange(len(at) - 1), np.diff(at)))
            places.append(np.arange(len(gram)) - np.repeat(at[:-1], np.diff(at)))
        self.lengths = np.array([len(w) for w in hashes], np.int64)
        self.words = np.concatenate([*hashes, np.zeros(1, np.uint64)])
        self.begin = np.cumsum(self.lengths) - self.lengths
        gram, owner, place = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (grams, owners, places))
        by = np.lexsort((place, owner, gram))
        self.seed_owner, self.seed_place = owner[by], place[by]
        self.seeds, self.first, self.times = np.unique(gram[by].astype(np.uint64), return_index=True, return_counts=True)
        self.mask = np.zeros(1 << _MASK_BITS, bool)
        self.mask[(self.seeds >> np.uint64(64 - _MASK_BITS)).astype(np.int64)] = True

    def hits(self, gram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places in ``gram``, seed numbers) of all seeds."""
        maybe = np.flatnonzero(self.mask[(gram >> np.uint64(64 - _MASK_BITS)).astype(np.int64)])
        if not len(maybe):
            return maybe, maybe
        at = np.minimum(np.searchsorted(self.seeds, gram[maybe]), len(self.seeds) - 1)
        real = self.seeds[at] == gram[maybe]
        return maybe[real], at[real]


def best_alignment(item: np.ndarray, passage: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smith-Waterman (score, place after its last word in the passage) of each row of ``item`` and ``passage``.

    Rows are filled up with values that match nothing. A gap to the left is a running maximum, so
    one step fills a whole row of the table for all pairs.
    """
    n, width = passage.shape
    above = np.zeros((n, width + 1))
    best, end = np.zeros(n), np.zeros(n, np.int64)
    slope = -GAP * np.arange(width + 1)
    for i in range(item.shape[1]):
        row = np.zeros((n, width + 1))
        row[:, 1:] = np.maximum(above[:, :-1] + np.where(passage == item[:, i : i + 1], MATCH, MISMATCH), above[:, 1:] + GAP)
        np.maximum(row, 0, out=row)
        above = np.maximum.accumulate(row + slope, axis=1) - slope
        at = above.argmax(axis=1)
        value = above[np.arange(n), at]
        better = value > best
        best[better], end[better] = value[better], at[better]
    return best, end


def _held(text: np.ndarray, passage: np.ndarray) -> np.ndarray:
    """How many words of each row of ``text`` occur in the same row of ``passage``; hashes that agree by chance only add."""
    row = np.arange(len(text), dtype=np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15)
    return np.isin(mix(text ^ row), mix(passage ^ row)).sum(axis=1)


def _passages(items: Items, place: np.ndarray, seed: np.ndarray, at: np.ndarray, firsts: np.ndarray, threshold: float):
    """(document, item, first word, word after the last) of the passages around the seed hits of a slice."""
    doc = np.searchsorted(at, place, "right") - 1
    position = firsts[doc] + place - at[doc]
    times = items.times[seed]
    entry = np.repeat(items.first[seed] - np.cumsum(times) + times, times) + np.arange(times.sum())
    doc, item = np.repeat(doc, times), items.seed_owner[entry]
    diagonal = np.repeat(position, times) - items.seed_place[entry]
    by = np.lexsort((diagonal, item, doc))
    doc, item, diagonal = doc[by], item[by], diagonal[by]
    # The words that a passing alignment can leave out or put in: beyond them nothing belongs to the same one.
    pad = np.ceil(max(0.0, 1 - threshold) * MATCH * items.lengths[item] / -GAP).astype(np.int64)
    fresh = np.ones(len(doc), bool)
    fresh[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (diagonal[1:] - diagonal[:-1] > pad[1:])
    first = np.flatnonzero(fresh)
    final = np.append(first[1:], len(doc)) - 1
    doc, item, pad = doc[first], item[first], pad[first]
    begin = np.maximum(diagonal[first] - pad, firsts[doc])
    stop = np.minimum(diagonal[final] + items.lengths[item] + pad, firsts[doc + 1])
    return doc, item, begin, stop


def _portions(at: np.ndarray, place: np.ndarray, times: np.ndarray) -> Iterator[slice]:
    """Runs of hits, whole documents each, with about ``HITS_AT_ONCE`` pairs of a hit and an item."""
    doc = np.searchsorted(at, place, "right") - 1
    ends = np.append(np.flatnonzero(np.diff(doc)) + 1, len(doc))
    low, done = 0, 0
    total = np.cumsum(times)
    for end, following in zip(ends, [*ends[1:], None], strict=True):
        if following is None or total[following - 1] - done > HITS_AT_ONCE:
            yield slice(low, end)
            low, done = end, total[end - 1]


def leaks(items: Items, column: pa.Array, threshold: float) -> Iterator[tuple[int, int, float, int, int]]:
    """(row, item number, score, first word, number of words) of the best passage of each row and item that reaches ``threshold``."""
    for low, _, data, bounds in text_slices(column):
        starts, ends, firsts = words(data, bounds, BETWEEN)
        word = word_hashes(data, starts, ends)
        gram, at = shingles(word, firsts, GRAM)
        place, seed = items.hits(gram)
        for portion in _portions(at, place, items.times[seed]) if len(place) else ():
            doc, item, begin, stop = _passages(items, place[portion], seed[portion], at, firsts, threshold)
            for (row, number), (score, one, two) in sorted(_aligned(items, word, firsts, doc, item, begin, stop, threshold).items()):
                yield low + row, number, score, one, max(two - one, 0)


def _aligned(items: Items, word, firsts, doc, item, begin, stop, threshold: float) -> dict[tuple[int, int], tuple[float, int, int]]:
    """By document and item: score, first word and word after the last of the best passage that reaches ``threshold``."""
    found: dict[tuple[int, int], tuple[float, int, int]] = {}
    size = stop - begin
    order = np.argsort(size, kind="stable")
    while len(order):
        next_ = order[:4096]
        many = max(1, int(CELLS_AT_ONCE // max(1, size[next_].max(), items.lengths[item[next_]].max())))
        part, order = order[: min(many, 4096)], order[min(many, 4096) :]
        width = int(size[part].max())
        at_word = begin[part][:, None] + np.arange(width)
        # 0 and 1 fill up passages and items; neither equals the other.
        passage = np.where(np.arange(width) < size[part][:, None], word[np.minimum(at_word, len(word) - 1)] | np.uint64(2), np.uint64(0))
        longest = int(items.lengths[item[part]].max())
        length = items.lengths[item[part]][:, None]
        at_item = np.minimum(items.begin[item[part]][:, None] + np.arange(longest), len(items.words) - 1)
        text = np.where(np.arange(longest) < length, items.words[at_item] | np.uint64(2), np.uint64(1))
        # A score is at most the share of the item's words that the passage holds at all.
        able = np.flatnonzero(_held(text, passage) / length[:, 0] >= threshold - 1e-9)
        if not len(able):
            continue
        part, passage, text, length = part[able], passage[able], text[able], length[able]
        score, end = best_alignment(text, passage)
        score = score / (MATCH * length[:, 0])
        good = np.flatnonzero(score >= threshold)
        if not len(good):
            continue
        _, back = best_alignment(text[good][:, ::-1], passage[good][:, ::-1])
        for k, b in zip(good, back, strict=True):
            key = (int(doc[part[k]]), int(item[part[k]]))
            start = int(begin[part[k]] - firsts[doc[part[k]]])
            own = (float(score[k]), start + width - int(b), start + int(end[k]))
            if key not in found or own[0] > found[key][0]:
                found[key] = own
    return found


def _slices(benchmark: DataFrame) -> Iterator[Items]:
    """The benchmark's items with their seeds, a slice of at most about ``SLICE_BYTES`` of text at a time."""
    own = benchmark.filter(F.col("text").isNotNull()).select("item_id", "text")
    total = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = -(-total // SLICE_BYTES)
    for part in range(parts):
        rows = own.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part).collect()
        items = Items(sorted(rows, key=lambda r: (r["item_id"] is None, 0 if r["item_id"] is None else r["item_id"], r["text"])))
        if len(items.seeds):
            yield items


def find_leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id``, ``item_id``, ``score`` (share of the item, 0 to 1), ``first_word`` and ``n_words`` of every leak.

    A leak is a row of ``docs`` with a passage whose alignment with an item reaches ``threshold``; of
    several passages the best counts. NULL and empty texts and items have no leaks; an item of fewer
    words than a seed leaks only into a text of just those words. Repeated rows are reported each;
    other columns are not read. Without documents or items the result is empty.
    """
    spark = docs.sparkSession
    id_type, item_type = docs.schema["doc_id"].dataType, benchmark.schema["item_id"].dataType
    schema = f"doc_id {id_type.simpleString()}, item_id {item_type.simpleString()}, score double, first_word long, n_words long"
    result = spark.createDataFrame([], schema)
    item_arrow = to_arrow_type(item_type)
    for items in _slices(benchmark):

        def search(batches, items=items):
            for batch in batches:
                found = list(leaks(items, batch.column("text"), threshold))
                if found:
                    row, number, score, first, n = zip(*found, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("doc_id").take(pa.array(row)), pa.array([items.ids[i] for i in number], item_arrow),
                         pa.array(score, pa.float64()), pa.array(first, pa.int64()), pa.array(n, pa.int64())],
                        ["doc_id", "item_id", "score", "first_word", "n_words"],
                    )

        result = result.unionByName(docs.select("doc_id", "text").mapInArrow(search, schema))
    return result


def drop_leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` without a leak, with all their columns."""
    kept = docs
    for items in _slices(benchmark):

        def clean(batches, items=items):
            # Rows go back in portions: neither the worker nor the executor holds a second whole batch.
            for own in (x for batch in batches for x in portions(batch)):
                leaked = np.unique([row for row, *_ in leaks(items, own.column("text"), threshold)]).astype(np.int64)
                yield own.take(pa.array(np.setdiff1d(np.arange(own.num_rows), leaked)))

        kept = kept.mapInArrow(clean, docs.schema)
    return kept
