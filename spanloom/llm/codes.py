"""Vector codes: each part of a vector is replaced by the number of its codebook's nearest entry.

Components are whole numbers, so codebooks, codes and errors are exact and do not depend on how the
rows are dealt out. The nearest entry is found through memoised grid cells: space is cut into boxes
``CELL`` wide, a part's box is looked up by a hash of its coordinates, and for every box met the
entries are kept that some point of the box may be nearest to: those whose least distance to the box
is no more than the smallest of all entries' largest distances. Only these are then evaluated.

Fitting sends sums per entry to the driver: at most parts x entries x width of a part of them.
"""

from __future__ import annotations

import hashlib
import math
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..operators.lookup import lookup
from ..operators.staging import stage
from .common import unused, without

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
CELL_BITS = 4
MAX_CELLS = 1 << 16
NEW_CELLS_AT_ONCE = 4096
# Components up to this size have squared distances of a part that fit 64 bits; others go by Python's integers.
LIMIT = 1 << 27
MAX_LONG = (1 << 63) - 1
LOW_BITS = 60


class Codebooks(NamedTuple):
    """``entries[part][entry]`` are tuples of whole components; vectors have ``dim`` of them before padding."""

    dim: int
    entries: list[list[tuple[int, ...]]]

    def sha256(self) -> str:
        flat = (str(x) for book in self.entries for entry in book for x in entry)
        return hashlib.sha256(",".join(flat).encode()).hexdigest()


def whole(x: float) -> int:
    """floor(256 * x), exact for every finite number."""
    return int(x) * SCALE if abs(x) >= 1 << 53 else math.floor(x * SCALE)


class PartCoder:
    """Nearest entries of one codebook, with the candidates of every grid cell met so far."""

    def __init__(self, book: list[tuple[int, ...]], bits: int = CELL_BITS) -> None:
        self.book, self.bits = book, bits
        self.small = all(abs(x) <= LIMIT for entry in book for x in entry)
        if self.small:
            self.entries = np.array(book, np.int64).reshape(len(book), -1)
            self._forget()

    def _forget(self) -> None:
        self.keys = np.empty(0, np.uint64)
        self.slots = np.empty(0, np.int64)
        self.cells = np.empty((0, self.entries.shape[1]), np.int64)
        self.first, self.count = np.empty(0, np.int64), np.empty(0, np.int64)
        self.flat = np.empty(0, np.int16)

    def exact(self, value: list[int]) -> tuple[int, int]:
        """Number of the nearest entry and its squared distance, by Python's integers."""
        return min((sum((a - b) ** 2 for a, b in zip(value, entry, strict=True)), i) for i, entry in enumerate(self.book))[::-1]

    def _hash(self, cells: np.ndarray) -> np.ndarray:
        key = np.zeros(len(cells), np.uint64)
        for column in cells.T.astype(np.uint64):
            key = (key ^ column) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(29)
        return key

    def _learn(self, keys: np.ndarray, cells: np.ndarray) -> None:
        """Add the candidates of new cells to the memory."""
        if len(self.keys) + len(keys) > MAX_CELLS:
            self._forget()
        flats, counts = [self.flat], []
        for at in range(0, len(cells), NEW_CELLS_AT_ONCE):
            low = cells[at : at + NEW_CELLS_AT_ONCE, None, :] << self.bits
            below, above = low - self.entries, self.entries - (low + (1 << self.bits) - 1)
            nearest = np.maximum(np.maximum(below, above), 0)
            farthest = np.maximum(-below, -above)
            least, most = (nearest * nearest).sum(2), (farthest * farthest).sum(2)
            row, entry = np.nonzero(least <= most.min(axis=1, keepdims=True))
            flats.append(entry.astype(np.int16))
            counts.append(np.bincount(row, minlength=len(low)))
        counted = np.concatenate(counts)
        first = len(self.flat) + np.cumsum(counted) - counted
        self.slots = np.concatenate([self.slots, len(self.cells) + np.arange(len(keys))])
        self.keys, self.cells = np.concatenate([self.keys, keys]), np.concatenate([self.cells, cells])
        self.first, self.count = np.concatenate([self.first, first]), np.concatenate([self.count, counted])
        self.flat = np.concatenate(flats)
        order = np.argsort(self.keys, kind="stable")
        self.keys, self.slots = self.keys[order], self.slots[order]

    def _lookup(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key, -1 where it is not known."""
        if not len(self.keys):
            return np.full(len(keys), -1)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.slots[at], -1)

    def nearest(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry numbers and squared distances of the rows of ``values`` (whole numbers up to ``LIMIT``)."""
        if not self.small:
            found = [self.exact([int(x) for x in v]) for v in values]
            return np.array([f[0] for f in found], np.int64), np.array([min(f[1], MAX_LONG) for f in found], np.int64)
        cells = values >> self.bits
        keys, first, inverse = np.unique(self._hash(cells), return_index=True, return_inverse=True)
        met = cells[first]
        new = self._lookup(keys) < 0
        if new.any():
            self._learn(keys[new], met[new])
            if (lost := self._lookup(keys) < 0).any():  # the memory was full and begun anew
                self._learn(keys[lost], met[lost])
        slot = self._lookup(keys)[inverse]
        same = (self.cells[slot] == cells).all(axis=1)
        best, dist = np.zeros(len(values), np.int64), np.full(len(values), MAX_LONG)
        for i in np.flatnonzero(~same):  # another cell of the same hash
            best[i], dist[i] = self.exact([int(x) for x in values[i]])
        count = np.where(same, self.count[slot], 0)
        order = np.argsort(-count, kind="stable")
        ranked, at, left = values[order], self.first[slot][order], -np.sort(-count)
        own_best, own_dist = best[order], dist[order]
        for j in range(int(count.max(initial=0))):
            n = int(np.searchsorted(-left, -j))  # rows with more than j candidates stand first
            entry = self.flat[at[:n] + j]
            away = ranked[:n] - self.entries[entry]
            d = np.einsum("ij,ij->i", away, away)
            better = d < own_dist[:n]
            own_best[:n][better], own_dist[:n][better] = entry[better], d[better]
        best[order], dist[order] = own_best, own_dist
        return best, dist


class Coder:
    """Codes of whole vectors; keeps the memory of its parts from batch to batch."""

    def __init__(self, books: Codebooks) -> None:
        self.parts = [PartCoder(book) for book in books.entries]
        self.dim, self.width = books.dim, len(books.entries[0][0])

    def split(self, vectors: pa.Array) -> tuple[np.ndarray, dict[int, list[int]]]:
        """Whole components (rows, parts, width), and those of the rows that have too large ones."""
        n = len(vectors)
        values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, self.dim)
        with np.errstate(over="ignore"):
            scaled = np.floor(values * SCALE)
        padding = len(self.parts) * self.width - self.dim
        large = np.flatnonzero((np.abs(scaled) > LIMIT).any(axis=1)) if self.dim else []
        exact = {int(i): [whole(float(x)) for x in values[i]] + [0] * padding for i in large}
        scaled[list(exact)] = 0
        return np.pad(scaled.astype(np.int64), ((0, 0), (0, padding))).reshape(n, len(self.parts), self.width), exact

    def nearest(self, whole_parts: np.ndarray, exact: dict[int, list[int]]) -> tuple[np.ndarray, np.ndarray, dict[int, int]]:
        """Codes (rows, parts), summed squared distances, and those of rows of ``exact`` as Python's integers."""
        codes = np.empty(whole_parts.shape[:2], np.int64)
        errors = [0] * len(codes) if not all(p.small for p in self.parts) else np.zeros(len(codes), np.int64)
        for p, part in enumerate(self.parts):
            codes[:, p], dist = part.nearest(whole_parts[:, p])
            errors = errors + dist if isinstance(errors, np.ndarray) else [a + int(b) for a, b in zip(errors, dist, strict=True)]
        beyond = {}
        for i, vector in exact.items():
            found = [part.exact(vector[p * self.width : (p + 1) * self.width]) for p, part in enumerate(self.parts)]
            codes[i] = [f[0] for f in found]
            beyond[i] = sum(f[1] for f in found)
        return codes, errors, beyond


def usable(vector: Column) -> Column:
    """Vectors without NULL or non-finite components."""
    finite = lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))
    return vector.isNotNull() & F.coalesce(F.forall(vector, finite), F.lit(False))


def _rows(df: DataFrame, vector: str, dim: int) -> DataFrame:
    return df.filter(usable(F.col(vector)) & (F.size(vector) == dim))


def start(df: DataFrame, vector: str, key: str, parts: int, entries: int) -> Codebooks | None:
    """Codebooks of the parts of the ``entries`` smallest keys; None without a usable row.

    Equal keys are ordered by their vectors, NULL keys come last.
    """
    lengths = df.filter(usable(F.col(vector))).groupBy(F.size(vector).alias("dim")).count()
    most = lengths.orderBy(F.desc("count"), F.desc("dim")).first()
    if most is None:
        return None
    dim, width = most["dim"], max(-(-most["dim"] // parts), 1)
    least = _rows(df, vector, dim).select(F.col(key).alias("k"), F.col(vector).cast("array<double>").alias("v"))
    first = [[whole(x) for x in r["v"]] + [0] * (parts * width - dim) for r in least.orderBy(F.asc_nulls_last("k"), "v").limit(entries).collect()]
    return Codebooks(dim, [[tuple(v[p * width : (p + 1) * width]) for v in first] for p in range(parts)])


def improved(df: DataFrame, vector: str, books: Codebooks) -> Codebooks:
    """``books`` after one round: each entry becomes the floor of the mean of its parts."""
    parts, entries, width = len(books.entries), len(books.entries[0]), len(books.entries[0][0])

    def sums(batches):
        coder, total = Coder(books), np.zeros((parts, entries, width), np.int64)
        counts, beyond = np.zeros((parts, entries), np.int64), {}
        for batch in batches:
            values, exact = coder.split(batch.column(0))
            codes, _, _ = coder.nearest(values, exact)
            for p in range(parts):
                counts[p] += np.bincount(codes[:, p], minlength=entries)
                np.add.at(total[p], codes[:, p], values[:, p])
            for i, vector_ in exact.items():
                for j, x in enumerate(vector_):
                    place = (j // width, int(codes[i, j // width]), j % width)
                    beyond[place] = beyond.get(place, 0) + x
        used = np.argwhere(counts > 0)
        rows = [(int(p), int(e), j, int(counts[p, e]), *divmod(int(total[p, e, j]) + beyond.get((p, e, j), 0), 1 << LOW_BITS)) for p, e in used for j in range(width)]
        if rows:
            p, e, j, n, high, low = zip(*rows, strict=True)
            wide = pa.decimal128(38, 0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(p, pa.int32()), pa.array(e, pa.int32()), pa.array(j, pa.int32()), pa.array(n, pa.int64()),
                 pa.array(map(Decimal, high), wide), pa.array(map(Decimal, low), wide)], ["part", "entry", "at", "n", "high", "low"])

    vectors = _rows(df, vector, books.dim).select(F.col(vector).cast("array<double>").alias("v"))
    found = vectors.mapInArrow(sums, "part int, entry int, at int, n long, high decimal(38,0), low decimal(38,0)")
    new = [[list(entry) for entry in book] for book in books.entries]
    for r in found.groupBy("part", "entry", "at").agg(F.sum("n").alias("n"), F.sum("high").alias("high"), F.sum("low").alias("low")).collect():
        new[r["part"]][r["entry"]][r["at"]] = ((int(r["high"]) << LOW_BITS) + int(r["low"])) // r["n"]
    return Codebooks(books.dim, [[tuple(entry) for entry in book] for book in new])


def fit(df: DataFrame, vector: str = "embedding", key: str = "vec_id", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks | None:
    """Codebooks learned from all usable rows of ``df``; None if there is none."""
    books = start(df, vector, key, parts, entries)
    for _ in range(rounds if books else 0):
        books = improved(df, vector, books)
    return books


def encode(df: DataFrame, books: Codebooks | None, vector: str = "embedding") -> DataFrame:
    """Usable rows of ``df`` with ``code`` (two hex digits a part) and ``error`` (squared, whole units); such input columns are replaced.

    Rows whose vector is NULL, holds NULL or non-finite components, or is not as long as most
    others, are left out. Vectors that cannot be cut equally are read as if zeros followed. Repeated
    rows are coded each. An error above the largest long is given as that. Without codebooks, as
    of an empty table, there are no rows.
    """
    rows = without(df, "code", "error")
    names = rows.columns
    schema = StructType([*rows.schema.fields, StructField("code", StringType()), StructField("error", LongType())])
    if books is None:
        return df.sparkSession.createDataFrame([], schema)
    own = _rows(rows, vector, books.dim)

    def code(batches):
        coder = Coder(books)
        for batch in batches:
            codes, errors, beyond = coder.nearest(*coder.split(batch.column(len(names))))
            digits = codes.astype(np.uint8).tobytes().hex()
            step = 2 * codes.shape[1]
            texts = [digits[i * step : (i + 1) * step] for i in range(len(codes))]
            errors = [min(beyond.get(i, int(e)), MAX_LONG) for i, e in enumerate(errors)] if beyond or isinstance(errors, list) else errors
            arrays = [batch.column(i) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(texts, pa.string()), pa.array(errors, pa.int64())], [*names, "code", "error"])

    plain = own.select(*[F.col(f"`{c}`") for c in names], F.col(f"`{vector}`").cast("array<double>").alias(unused(rows, "_vector")))
    return plain.mapInArrow(code, schema)


def with_label_errors(coded: DataFrame, label: str = "label") -> DataFrame:
    """``coded`` (a table that can be read twice) with ``label_error``: the errors of all rows of its label, NULL included, together."""
    totals = coded.groupBy(F.col(label)).agg(
        F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(MAX_LONG).cast("decimal(38,0)")).cast("long").alias("label_error")
    )
    return lookup(coded, totals, [label], null_safe=True)


def compressed(df: DataFrame, vector: str = "embedding", key: str = "vec_id", label: str = "label") -> DataFrame:
    """Keys, labels, codes and errors of all usable rows with codebooks of their own, whose digest is in every row."""
    books = fit(df, vector, key)
    coded = stage(encode(df.select(key, label, vector), books, vector).drop(vector), "vector-codes")
    return with_label_errors(coded, label).withColumn("codebooks_sha256", F.lit(books.sha256() if books else None).cast("string"))
