"""N-gram Jaccard join of documents with set-relation skipping.

1. Exact classes: documents with the same set of shingles are one set from here on.
2. Answers from a similar set: sets that share a minimum of their hashes with a leader and are
   verified to link with it take the leader's component; no pair inside a component is looked at
   again, so a group of n copies costs n comparisons, not n squared.
3. Index lists: every set is listed under the shingles of its prefix, rarest first. A list is kept
   in order of set size with the position of the shingle in each set, and is read in blocks: entries
   too far into their set to reach the overlap as the smaller side, sizes too different, entries of
   the same component, and positions with too little left are skipped.
4. Candidates that a bound from parity bits does not rule out are verified on the whole texts;
   links give the components.

The order of the shingles comes from a document-frequency sketch of fixed size over all documents.
It decides only how many candidates there are; with any order every link is found.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..operators.lookup import lookup
from ..operators.staging import stage, stage_alone
from .common import maybe_in, parallelism
from .graph import components
from .hashing import mix, sets, shingles, text_slices, word_hashes, words

COUNTER_BITS = 21
COUNTERS = 1 << COUNTER_BITS
SEGMENTS = 64
BINS = 32
PARITY_BITS = 1024
KEY_BINS = (0, 8, 16, 24)
HOT_LIST = 50_000
ENTRIES_PER_BUCKET = 2_000_000
PAIRS_AT_ONCE = 500_000


def _column(values: np.ndarray, kind=None) -> pa.Array:
    return pa.array(values, kind)


def _counter(token: np.ndarray) -> np.ndarray:
    return (token >> np.uint64(64 - COUNTER_BITS)).astype(np.int64)


def _packed(values: np.ndarray) -> bytes:
    return pa.compress(values.tobytes(), codec="zstd", asbytes=True)


def _unpacked(data: bytes, width: int, kind) -> np.ndarray:
    size = width * np.dtype(kind).itemsize
    return np.frombuffer(pa.decompress(data, size, codec="zstd", asbytes=True), kind)


def frequency_sketch(docs: DataFrame, n: int) -> np.ndarray:
    """Hashed shingle counts over all documents, ``COUNTERS`` of them whatever the corpus."""
    width = COUNTERS // SEGMENTS

    def count(batches):
        total = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            for _, _, data, bounds in text_slices(batch.column("text")):
                starts, ends, firsts = words(data, bounds)
                found, _ = shingles(word_hashes(data, starts, ends), firsts, n)
                total += np.bincount(_counter(found), minlength=COUNTERS)
        if total.any():
            yield pa.RecordBatch.from_arrays(
                [_column(np.arange(SEGMENTS), pa.int32()), pa.array([_packed(row) for row in total.astype(np.uint32).reshape(SEGMENTS, width)], pa.binary())],
                ["segment", "counts"],
            )

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for segment, counts in zip(batch.column("segment").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                sums[segment] = sums.get(segment, 0) + _unpacked(counts, width, np.uint32).astype(np.int64)
        for segment, counts in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([segment], pa.int32()), pa.array([_packed(counts)], pa.binary())], ["segment", "counts"])

    kind = "segment int, counts binary"
    parts = docs.select("text").mapInArrow(count, kind).repartitionById(SEGMENTS, F.col("segment")).mapInArrow(add, kind).collect()
    total = np.zeros(COUNTERS, np.int64)
    for part in parts:
        total[part["segment"] * width : (part["segment"] + 1) * width] = _unpacked(part["counts"], width, np.int64)
    return total


def ordering(counts: np.ndarray) -> np.ndarray:
    """Class of each counter: 0 within the noise of the usual count, two more for each doubling above it.

    What rare shingles add to a counter is the same for all within its square root, so shingles
    that are frequent stand out however many documents there are.
    """
    usual = np.median(counts)
    classes = np.empty(len(counts), np.uint8)
    for low in range(0, len(counts), 1 << 16):
        above = (counts[low : low + (1 << 16)] - usual) / (3 * np.sqrt(max(usual, 1)))
        classes[low : low + (1 << 16)] = np.where(above < 1, 0, 1 + 2 * np.log2(np.maximum(above, 1)))
    return classes


def excess(counts: np.ndarray) -> np.ndarray:
    """Base-2 logarithm of what each counter has above the usual: the length of a frequent shingle's list at most."""
    usual = np.median(counts)
    logs = np.empty(len(counts), np.uint8)
    for low in range(0, len(counts), 1 << 16):
        logs[low : low + (1 << 16)] = np.log2(np.maximum(counts[low : low + (1 << 16)] - usual, 1))
    return logs


def prefix_length(n: int, percent: int) -> tuple[int, int]:
    """(length of the prefix of a set of ``n``, positions where it can be the smaller or equal side of a link)."""
    whole = n - -(-percent * n // 100) + 1
    near = n - -(-percent * 2 * n // (100 + percent)) + 1
    return whole, near


def build_sets(docs: DataFrame, n: int, percent: int, classes) -> DataFrame:
    """Per row of ``docs``: size, 128-bit digest, prefix, hash minima and parity bits of its set of shingles."""
    edges = (np.arange(1, BINS, dtype=np.uint64)) << np.uint64(64 - int(math.log2(BINS)))

    def build(batches):
        order = classes.value
        for batch in batches:
            size, low, high, prefix, minima, parity = [], [], [], [], [], []
            for _, found in sets(batch.column("text"), n):
                k = len(found)
                size.append(k)
                low.append(int(mix(found).sum(dtype=np.uint64).astype(np.int64)))
                high.append(int(mix(found ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).astype(np.int64)))
                parity.append(np.packbits(np.bincount((found & np.uint64(PARITY_BITS - 1)).astype(np.int64), minlength=PARITY_BITS) & 1).tobytes())
                if not k:
                    prefix.append(b"")
                    minima.append([0] * BINS)
                    continue
                rank = np.argsort(order[_counter(found)], kind="stable")[: prefix_length(k, percent)[0]]
                prefix.append(found[rank].tobytes())
                at = np.concatenate(([0], np.searchsorted(found, edges), [k]))
                filled = at[1:] > at[:-1]
                values = np.zeros(BINS, np.int64)
                values[filled] = (found[at[:-1][filled]] & np.uint64(0x7FFFFFFF)).astype(np.int64) + 1
                minima.append(values.tolist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(size, pa.int64()), pa.array(low, pa.int64()), pa.array(high, pa.int64()),
                 pa.array(prefix, pa.binary()), pa.array(minima, pa.list_(pa.int64())), pa.array(parity, pa.binary())],
                ["doc_id", "n", "d1", "d2", "prefix", "minima", "parity"],
            )

    return docs.select("doc_id", "text").mapInArrow(build, "doc_id long, n long, d1 long, d2 long, prefix binary, minima array<long>, parity binary")


def possible(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The ``pairs`` that parity bits do not rule out.

    Each element flips one of ``PARITY_BITS`` bits, so two sets differ in at least as many elements
    as their bits do; a link allows only so many. No link is lost.
    """
    bits = classes.select("rep", "n", "parity")
    with_a = lookup(pairs, bits.select(F.col("rep").alias("a"), F.col("n").alias("_na"), F.col("parity").alias("_pa")), ["a"], "inner")
    with_b = lookup(with_a, bits.select(F.col("rep").alias("b"), F.col("n").alias("_nb"), F.col("parity").alias("_pb")), ["b"], "inner")

    def check(batches):
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint64).reshape(batch.num_rows, -1) for c in ("_pa", "_pb"))
            apart = np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64)
            both = batch.column("_na").to_numpy() + batch.column("_nb").to_numpy()
            keep = pa.array(apart <= both - 2 * -(-percent * both // (100 + percent)))
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], ["a", "b"])

    return with_b.select("a", "b", "_na", "_nb", "_pa", "_pb").mapInArrow(check, "a long, b long").distinct()


def verify(pairs: DataFrame, docs: DataFrame, n: int, percent: int) -> DataFrame:
    """The ``pairs`` (``a``, ``b``) whose texts link, by intersecting the whole sets."""
    ids = stage(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "pair-ids")
    # Texts of no pair are not shuffled.
    asked = maybe_in(docs.select("doc_id", "text"), "doc_id", ids, "_asked").filter("_asked").drop("_asked")
    texts = stage(asked.join(ids, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"]), "pair-texts")
    with_a = lookup(pairs, texts.select(F.col("doc_id").alias("a"), F.col("text").alias("_ta")), ["a"], "inner")
    with_b = lookup(with_a, texts.select(F.col("doc_id").alias("b"), F.col("text").alias("_tb")), ["b"], "inner")

    def check(batches):
        for batch in batches:
            linked = np.zeros(batch.num_rows, bool)
            for (i, x), (_, y) in zip(sets(batch.column("_ta"), n), sets(batch.column("_tb"), n), strict=True):
                if not len(x) or not len(y) or percent * max(len(x), len(y)) > 100 * min(len(x), len(y)):
                    continue
                both = len(np.intersect1d(x, y, assume_unique=True))
                linked[i] = 100 * both >= percent * (len(x) + len(y) - both)
            keep = pa.array(linked)
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], ["a", "b"])

    return with_b.select("a", "b", "_ta", "_tb").mapInArrow(check, "a long, b long").distinct()


def star_pairs(classes: DataFrame, percent: int) -> DataFrame:
    """(leader, set) for sets that share one of their hash minima with the leader and are probably similar."""
    keyed = classes.select("rep", "n", "minima", F.explode(F.array(*[F.struct(F.lit(b).alias("bin"), F.get("minima", F.lit(b)).alias("low")) for b in KEY_BINS])).alias("_key"))
    keyed = keyed.filter(F.col("_key.low") > 0).select("rep", "n", "minima", "_key.bin", "_key.low")
    leaders = keyed.groupBy("bin", "low").agg(F.min(F.struct("rep", "n", "minima")).alias("_leader"), F.count(F.lit(1)).alias("_size"))
    led = lookup(keyed, leaders.filter(F.col("_size") > 1).drop("_size"), ["bin", "low"], "inner").filter(F.col("rep") != F.col("_leader.rep"))
    sizes = 100 * F.least("n", "_leader.n") >= percent * F.greatest("n", "_leader.n")
    same = F.size(F.filter(F.zip_with("minima", "_leader.minima", lambda x, y: F.when(x == y, F.greatest(x, y)).otherwise(0)), lambda x: x > 0))
    filled = F.size(F.filter("minima", lambda x: x > 0))
    return led.filter(sizes & (100 * same >= (percent - 10) * filled)).select(F.col("_leader.rep").alias("a"), F.col("rep").alias("b")).distinct()


def candidate_pairs(classes: DataFrame, percent: int, logs, order, buckets: int) -> DataFrame:
    """Pairs of sets of different components (``comp``) that meet in an index list and may reach the overlap."""

    def post(batches):
        """Index entries by bucket, packed column by column: one row per batch and bucket."""
        for batch in batches:
            lengths = np.array([len(x) // 8 for x in batch.column("prefix").to_pylist()])
            token = np.frombuffer(b"".join(batch.column("prefix").to_pylist()), np.uint64)
            owner = np.repeat(np.arange(len(lengths)), lengths)
            position = np.arange(len(token)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            # A very long list is dealt to cells, each pair of its parts meeting in one.
            parts = np.maximum((1 << logs.value[_counter(token)].astype(np.int64)) // HOT_LIST, 1)
            parts[order.value[_counter(token)] == 0] = 1
            if (parts > 1).any():
                times = np.repeat(np.arange(len(token)), parts)
                cell = np.arange(len(times)) - np.repeat(np.cumsum(parts) - parts, parts)
                own = (mix(owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + token) % parts.astype(np.uint64)).astype(np.int64)[times]
                low, high = np.minimum(own, cell), np.maximum(own, cell)
                moved = mix(token[times] + (low * 65536 + high).astype(np.uint64) * np.uint64(0xD1342543DE82EF95))
                token, owner, position = np.where(parts[times] > 1, moved, token[times]), owner[times], position[times]
            bucket = (token % np.uint64(buckets)).astype(np.int64)
            by = np.argsort(bucket, kind="stable")
            cuts = np.flatnonzero(np.diff(bucket[by], prepend=-1, append=buckets))
            columns = [np.array(batch.column(c).to_numpy(zero_copy_only=False), np.int64) for c in ("rep", "comp", "n")]
            rep, comp, size = (c[owner[by]] for c in columns)
            token, position = token[by], position[by].astype(np.uint32)
            packed = [
                b"".join(x.tobytes() for x in (token[s:e], rep[s:e], comp[s:e], size[s:e].astype(np.uint32), position[s:e]))
                for s, e in zip(cuts[:-1], cuts[1:], strict=True)
            ]
            yield pa.RecordBatch.from_arrays([pa.array(bucket[by][cuts[:-1]], pa.int32()), pa.array(packed, pa.binary())], ["bucket", "entries"])

    def meet(batches):
        blobs = [x for batch in batches for x in batch.column("entries").to_pylist()]
        if blobs:
            for a, b in _meetings(blobs, percent):
                yield pa.RecordBatch.from_arrays([_column(a, pa.int64()), _column(b, pa.int64())], ["a", "b"])

    posted = classes.select("rep", "comp", "n", "prefix").mapInArrow(post, "bucket int, entries binary")
    return posted.repartitionById(buckets, F.col("bucket")).mapInArrow(meet, "a long, b long").distinct()


def _meetings(blobs: list[bytes], percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Candidates of the index lists of one bucket, the smaller id first, without repeats inside a yield."""
    columns: list[list[np.ndarray]] = [[], [], [], [], []]
    for blob in blobs:
        k, at = len(blob) // 32, 0
        for column, kind in zip(columns, (np.uint64, np.int64, np.int64, np.uint32, np.uint32), strict=True):
            width = k * np.dtype(kind).itemsize
            column.append(np.frombuffer(blob[at : at + width], kind))
            at += width
    token, rep, comp, size, position = (np.concatenate(c) for c in columns)
    size, position = size.astype(np.int64), position.astype(np.int64)
    by = np.lexsort((size, token))
    token, rep, comp, size, position = token[by], rep[by], comp[by], size[by], position[by]
    first = np.flatnonzero(np.diff(token, prepend=token[0] ^ np.uint64(1)))
    # Lists of one component have nothing to tell.
    mixed = np.minimum.reduceat(comp, first) != np.maximum.reduceat(comp, first)
    in_mixed = np.repeat(mixed, np.diff(np.append(first, len(token))))
    near = size - -(-percent * 2 * size // (100 + percent)) + 1
    active = np.flatnonzero(in_mixed & (position < near))
    left = size - position
    step, found_a, found_b, held = 0, [], [], 0
    while len(active):
        step += 1
        active = active[active + step < len(token)]
        other = active + step
        fits = (token[other] == token[active]) & (100 * size[active] >= percent * size[other])
        active, other = active[fits], other[fits]
        need = -(-percent * (size[active] + size[other]) // (100 + percent))
        wanted = (comp[active] != comp[other]) & (np.minimum(left[active], left[other]) >= need)
        if wanted.any():
            x, y = rep[active[wanted]], rep[other[wanted]]
            found_a.append(np.minimum(x, y))
            found_b.append(np.maximum(x, y))
            held += len(x)
        if held >= PAIRS_AT_ONCE or (held and not len(active)):
            pairs = np.unique(np.stack([np.concatenate(found_a), np.concatenate(found_b)], axis=1), axis=0)
            yield pairs[:, 0], pairs[:, 1]
            found_a, found_b, held = [], [], 0
    if held:
        pairs = np.unique(np.stack([np.concatenate(found_a), np.concatenate(found_b)], axis=1), axis=0)
        yield pairs[:, 0], pairs[:, 1]


def jaccard_classes(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` for every row of ``docs`` (``doc_id``, ``text``; others are not read).

    Two documents link when ``100 * shared >= percent * all`` of their distinct ``n``-word shingles;
    a document of fewer words has its whole sequence as one shingle. ``component_id`` is the smallest
    ``doc_id`` reachable by links, itself included. Documents without words or text link with nothing.
    Rows with one ``doc_id`` are one document whose every text counts for links; a NULL ``doc_id``
    has a NULL component and no links. An empty table gives an empty result. Shingles are compared by
    64-bit hashes.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    counts = frequency_sketch(texts, n)
    # Two arrays of COUNTERS bytes.
    order, logs = spark.sparkContext.broadcast(ordering(counts)), spark.sparkContext.broadcast(excess(counts))
    del counts
    rows = stage(build_sets(texts, n, percent, order), "shingle-sets")
    known = rows.filter((F.col("n") > 0) & F.col("doc_id").isNotNull())
    # Equal sets have equal prefixes and minima, so any of them will do.
    classes = stage(known.groupBy("n", "d1", "d2").agg(F.min("doc_id").alias("rep"), F.first("prefix").alias("prefix"), F.first("minima").alias("minima"), F.first("parity").alias("parity")), "shingle-classes")
    members = known.select("doc_id", "n", "d1", "d2").distinct()
    copies = lookup(members, classes.select("n", "d1", "d2", "rep"), ["n", "d1", "d2"], "inner").select(F.col("doc_id").alias("a"), F.col("rep").alias("b")).filter("a <> b")

    stars = stage(verify(stage(possible(star_pairs(classes, percent), classes, percent), "possible-stars"), texts, n, percent), "star-links")
    grouped = components(stars).select(F.col("node").alias("rep"), F.col("root").alias("_root"))
    listed = lookup(classes.select("rep", "n", "prefix"), grouped, ["rep"]).withColumn("comp", F.coalesce("_root", "rep"))
    entries = (classes.agg(F.sum(F.length("prefix"))).first()[0] or 0) // 8
    buckets = max(parallelism(spark), -(-entries // ENTRIES_PER_BUCKET))
    candidates = stage(candidate_pairs(listed, percent, logs, order, buckets), "candidates")
    links = verify(stage(possible(candidates, classes, percent), "possible-links"), texts, n, percent)
    linked = components(stars.unionByName(links).unionByName(copies)).select(F.col("node").alias("doc_id"), F.col("root").alias("_root"))
    return lookup(rows.select("doc_id", F.col("n").alias("n_shingles")), linked, ["doc_id"]).select("doc_id", "n_shingles", F.coalesce("_root", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that are the first of their component, and every row that links with nothing.

    Of rows that are equal in all columns one stays. Rows without ``doc_id`` stay.
    """
    def counted() -> DataFrame:
        return jaccard_classes(docs, n, percent).groupBy("doc_id").agg(F.min("component_id").alias("_component"), F.count(F.lit(1)).alias("_times"))

    classes = stage_alone(docs.sparkSession, counted, "components")
    gone = classes.filter(F.col("_component") != F.col("doc_id")).select(F.col("doc_id").alias("doc"), F.lit(True).alias("gone"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("doc"))
    # Only documents that may have to go are shuffled; the others stay where they are.
    asked = maybe_in(rows, "doc", gone, "asked")
    keyed = lookup(asked.filter("asked").drop("asked"), gone, ["doc"])
    kept = asked.filter(~F.col("asked")).select("row").unionByName(keyed.filter(F.col("gone").isNull()).select("row")).select("row.*")
    # Only repeated ids can have equal rows; without any, rows need not be compared.
    return kept.dropDuplicates() if classes.filter(F.col("doc_id").isNotNull() & (F.col("_times") > 1)).limit(1).count() else kept
