"""Suffix-array dedup: bytes of long strings that an earlier document holds too.

Every string of ``width`` bytes has a smallest k-gram (by hash). Consecutive strings with the same
one form a context, so a text is a chain of contexts and equal strings lie in contexts of the same
k-gram, wherever they stand.

1. Anchors: k-gram values are counted over all documents but copies of a whole text; a batch of
   documents sends each of its values once, with the number of its documents that hold it, and learns
   which occur in several documents. Only contexts of those go on.
2. Suffix sort: contexts meet by k-gram. Equal contexts are settled at once. The suffixes of the
   others are put in buckets by their first bytes and sorted by mergesort; two are compared by binary search for their common
   extension on prefix polynomial hashes and then by one byte. Neighbours with a common extension
   of ``width`` bytes, verified byte by byte, are equal strings; all but those of the smallest
   ``doc_id`` are removed. A k-gram of very many documents would bring all contexts of a common
   passage's edges to one task: its contexts are cut into strings of ``width`` bytes, each of a
   slice once, which meet by hash of the whole string and are compared as they are.
3. Each batch of documents is met with its removed spans.

Data move as packed, compressed arrays, one row per sender and receiver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..operators.lookup import lookup
from ..operators.staging import stage
from .common import parallelism
from .hashing import mix, prefix_hashes, span_hashes, text_slices

WIDTH = 50
GRAM = 25
BATCH_BYTES = 4 << 20
BUCKETS_PER_BATCH = 2
# Contexts of one k-gram in so many documents are some 20 MB with what their sort needs.
HOT_DOCS = 8192
_IPC = pa.ipc.IpcWriteOptions(compression="zstd")
DOCS, COPIES, REPEATED, CONTEXTS, SPANS, HOT, STRINGS = range(7)
ROW = "kind int, dest int, data binary"
# A row of the documents: two hashes of id and text, so that different rows do not pass for one.
ADDRESS = np.dtype([("one", np.int64), ("two", np.int64)])


def _rows(kind: int, dest: np.ndarray, data: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(data), kind), pa.int32()), pa.array(dest, pa.int32()), pa.array(data, pa.binary())], ["kind", "dest", "data"]
    )


def _pack(table: pa.Table | pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=_IPC) as writer:
        writer.write(table)
    return sink.getvalue().to_pybytes()


def _unpack(data: list[bytes]) -> pa.Table:
    return pa.concat_tables([pa.ipc.open_stream(x).read_all() for x in data])


def _split(dest: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(receiver, its row numbers in order) for every receiver."""
    by = np.argsort(dest, kind="stable")
    cuts = np.flatnonzero(np.diff(dest[by], prepend=-1))
    for rows in np.split(by, cuts[1:]) if len(by) else []:
        yield int(dest[rows[0]]), rows


def _post(kind: int, dest: np.ndarray, table: pa.Table | pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    parts = list(_split(dest))
    if parts:
        yield _rows(kind, np.array([d for d, _ in parts]), [_pack(table.take(pa.array(rows))) for _, rows in parts])


def contexts(data: np.ndarray, bounds: np.ndarray, width: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(k-gram value, start, end, text number) of the contexts of a slice of texts."""
    n = len(data) - width + 1
    if n <= 0:
        empty = np.empty(0, np.int64)
        return empty.astype(np.uint64), empty, empty, empty
    grams = gram_hashes(data, gram)
    window, span = grams, 1
    while span * 2 <= width - gram + 1:
        window = np.minimum(window[:-span], window[span:])
        span *= 2
    rest = width - gram + 1 - span
    least = np.minimum(window[:n], window[rest : rest + n])
    cross = np.zeros(n + 1, np.int32)
    inner = bounds[1:-1]
    low, high = np.clip(inner - width + 1, 0, n), np.clip(inner, 0, n)
    np.add.at(cross, low, 1)
    np.add.at(cross, high, -1)
    inside = np.cumsum(cross[:-1]) == 0
    fresh = np.ones(n, bool)
    fresh[1:] = (least[1:] != least[:-1]) | ~inside[:-1]
    starts = np.flatnonzero(inside & fresh)
    final = np.ones(n, bool)
    final[:-1] = fresh[1:] | ~inside[1:]
    ends = np.flatnonzero(inside & final) + width
    return least[starts], starts, ends, np.searchsorted(bounds, starts, "right") - 1


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    p = prefix_hashes(data)
    at = np.arange(len(data) - gram + 1)
    return mix(span_hashes(p, at, at + gram))


def eight_bytes(data: np.ndarray) -> np.ndarray:
    """The eight bytes at each place as one number that sorts like them; zeros follow the end."""
    wide = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
    out = np.zeros(len(data) + 1, np.uint64)
    for k in range(8):
        out = (out << np.uint64(8)) | wide[k : k + len(out)]
    return out


def _anchor_key(value: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, 32 further bits). Anchors that agree by chance only send contexts for nothing."""
    return (value % np.uint64(buckets)).astype(np.int64), (value >> np.uint64(32)).astype(np.uint32)


def _full_key(bucket, key: np.ndarray) -> np.ndarray:
    return (np.asarray(bucket, np.uint64) << np.uint64(32)) | key.astype(np.uint64)


def _addresses(table: pa.Table | pa.RecordBatch) -> np.ndarray:
    out = np.empty(table.num_rows, ADDRESS)
    out["one"], out["two"] = table.column("addr").to_numpy(), table.column("addr2").to_numpy()
    return out


def post_documents(docs: DataFrame) -> DataFrame:
    """Rows (id, address, batch, text) to their batches; equal rows once with their number."""

    def post(batches):
        for batch in batches:
            _, first, count = np.unique(_addresses(batch), return_index=True, return_counts=True)
            once = batch.take(pa.array(first))
            table = pa.Table.from_arrays([once.column("doc_id"), once.column("addr"), once.column("addr2"), pa.array(count, pa.int64()), once.column("text")], ["doc_id", "addr", "addr2", "times", "text"])
            yield from _post(DOCS, once.column("batch").to_numpy(), table)

    return docs.mapInArrow(post, ROW)


def batch_anchors(documents: pa.Table, facts: pa.Table, buckets: int, width: int, gram: int, hot: int) -> pa.Table:
    """Per batch of documents: its anchor keys to their buckets, each once with its number of documents, at most ``hot + 1``."""
    out = [_rows(REPEATED, np.empty(0, int), [])]
    if not documents.num_rows:
        return pa.Table.from_batches(out)
    home = documents.column("dest")[0].as_py()
    table = _compared(documents, facts)[0]
    kept = []
    for _, _, data, bounds in text_slices(table.column("text")):
        value, _, _, owner = contexts(data, bounds, width, gram)
        full = _full_key(*_anchor_key(value, buckets))
        by = np.argsort(full, kind="stable")
        full, owner = full[by], owner[by]
        new = np.ones(len(by), bool)
        new[1:] = (full[1:] != full[:-1]) | (owner[1:] != owner[:-1])
        kept.append(np.unique(full[new], return_counts=True))
    if not kept:
        return pa.Table.from_batches(out)
    full, which = np.unique(np.concatenate([k for k, _ in kept]), return_inverse=True)
    times = np.zeros(len(full), np.int64)
    np.add.at(times, which, np.concatenate([t for _, t in kept]))
    times = np.minimum(times, hot + 1)
    parts = list(_split((full >> np.uint64(32)).astype(np.int64)))
    data = []
    for _, rows in parts:
        # The batch, how many keys several documents hold, their numbers, those keys, then the others; 4 bytes each.
        several = times[rows] > 1
        rows = np.concatenate((rows[several], rows[~several]))
        head = np.concatenate(([home, several.sum()], times[rows[: several.sum()]])).astype(np.uint32)
        data.append(head.tobytes() + full[rows].astype(np.uint32).tobytes())
    if parts:
        out.append(_rows(REPEATED, np.array([d for d, _ in parts]), data))
    return pa.Table.from_batches(out)


def answer_anchors(posted: DataFrame, buckets: int, hot: int) -> DataFrame:
    """To every batch, the keys among its own that more than one document holds, and those that more than ``hot`` hold."""

    def answer(batches):
        keys, homes, counts = [], [], []
        dest = -1
        for batch in batches:
            for bucket, data in zip(batch.column("dest").to_pylist(), batch.column("data").to_pylist(), strict=True):
                dest, given = bucket, np.frombuffer(data, np.uint32)
                several = int(given[1])
                keys.append(given[2 + several :])
                homes.append(np.full(len(keys[-1]), given[0], np.int32))
                counts.append(np.concatenate((given[2 : 2 + several], np.ones(len(keys[-1]) - several, np.uint32))))
        if not keys:
            return
        key, home, count = np.concatenate(keys), np.concatenate(homes), np.concatenate(counts)
        by = np.argsort(key, kind="stable")
        key, home, count = key[by], home[by], count[by]
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        total = np.repeat(np.add.reduceat(count.astype(np.int64), first), np.diff(np.append(first, len(key))))
        for kind, least in ((REPEATED, 1), (HOT, hot)):
            rows_of = np.flatnonzero(total > least)
            parts = list(_split(home[rows_of]))
            if parts:
                yield _rows(kind, np.array([d for d, _ in parts]), [np.unique(_full_key(dest, key[rows_of[rows]])).tobytes() for _, rows in parts])

    return posted.repartitionById(buckets, F.col("dest")).mapInArrow(answer, ROW)


def _equal_bytes(data: np.ndarray, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether the strings at ``a`` and ``b`` are equal, byte by byte."""
    out = np.ones(len(a), bool)
    step = max(1, (1 << 22) // max(int(length.max(initial=1)), 1))
    for low in range(0, len(a), step):
        size = length[low : low + step]
        first = np.cumsum(size) - size
        at = np.arange(size.sum()) - np.repeat(first, size)
        same = data[np.repeat(a[low : low + step], size) + at] == data[np.repeat(b[low : low + step], size) + at]
        out[low : low + step] = np.logical_and.reduceat(same, first) if len(same) else True
    return out


def _classes(data, start, end, doc) -> np.ndarray:
    """Number of the representative of each string: the one of the smallest document among equal ones."""
    length = end - start
    hashed = mix(span_hashes(prefix_hashes(data), start, end) ^ length.astype(np.uint64))
    by = np.lexsort((doc, hashed))
    fresh = np.ones(len(by), bool)
    fresh[1:] = hashed[by][1:] != hashed[by][:-1]
    head = by[np.maximum.accumulate(np.where(fresh, np.arange(len(by)), 0))]
    rep = np.empty(len(by), np.int64)
    rep[by] = head
    other = np.flatnonzero(rep != np.arange(len(rep)))
    differs = length[other] != length[rep[other]]
    checked = other[~differs]
    wrong = ~_equal_bytes(data, start[checked], start[rep[checked]], length[checked])
    rep[other[differs]] = other[differs]
    rep[checked[wrong]] = checked[wrong]
    return rep


def _has_earlier(text: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Whether a smaller document holds the same string (of fixed width, compared byte by byte)."""
    by = np.argsort(text, kind="stable")
    fresh = np.ones(len(by), bool)
    fresh[1:] = text[by[1:]] != text[by[:-1]]
    group = np.flatnonzero(fresh)
    smallest = np.repeat(np.minimum.reduceat(doc[by], group), np.diff(np.append(group, len(by))))
    out = np.empty(len(by), bool)
    out[by] = doc[by] > smallest
    return out


def _string_type(width: int) -> np.dtype:
    """A row of ``STRINGS``: a string of ``width`` bytes and where it stands."""
    return np.dtype([("batch", np.int32), ("doc", np.int32), ("start", np.int32), ("doc_id", np.int64), ("text", f"S{width}")])


def _hot_strings(data, start, end, place, which, doc, home: int, buckets: int, width: int) -> list[pa.RecordBatch]:
    """The strings of contexts of hot anchors to buckets of their own; those with an earlier one in the slice are settled here."""
    windows = end - start - width + 1
    shift = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
    at = np.repeat(start, windows) + shift
    rows = np.empty(len(at), _string_type(width))
    rows["batch"], rows["doc"], rows["doc_id"] = home, np.repeat(which, windows), np.repeat(doc, windows)
    rows["start"] = np.repeat(place, windows) + shift
    rows["text"] = np.lib.stride_tricks.sliding_window_view(data, width)[at].view(f"S{width}")[:, 0]
    bucket = (mix(span_hashes(prefix_hashes(data), at, at + width)) % np.uint64(buckets)).astype(np.int64)
    later = _has_earlier(rows["text"], rows["doc_id"])
    out = []
    if later.any():
        low = rows["start"][later]
        spans = pa.table({"batch": rows["batch"][later], "doc": rows["doc"][later], "start": low.astype(np.int64), "end": low.astype(np.int64) + width})
        out.append(_rows(SPANS, bucket[later][:1], [_pack(spans)]))
    rows, bucket = rows[~later], bucket[~later]
    parts = list(_split(bucket))
    if parts:
        out.append(_rows(STRINGS, np.array([d for d, _ in parts]), [rows[r].tobytes() for _, r in parts]))
    return out


def _documents(pieces: list[bytes]) -> pa.Table:
    """The documents of a batch in order of address, equal rows once; a document's number here is its place."""
    table = _unpack(pieces).combine_chunks()
    address, first, which = np.unique(_addresses(table), return_index=True, return_inverse=True)
    times = np.bincount(which, weights=table.column("times").to_numpy(), minlength=len(address)).astype(np.int64)
    table = table.take(pa.array(first))
    return table.set_column(table.column_names.index("times"), "times", pa.array(times))


def _data(table: pa.Table, kind: int) -> list[bytes]:
    kinds, data = table.column("kind").to_pylist(), table.column("data").to_pylist()
    return [x for k, x in zip(kinds, data, strict=True) if k == kind]


def _numbers(pieces: list[bytes], kind) -> np.ndarray:
    return np.unique(np.concatenate([np.frombuffer(x, kind) for x in pieces] or [np.empty(0, kind)]))


def _copies(facts: pa.Table) -> np.ndarray:
    return _numbers(_data(facts, COPIES), ADDRESS)


def _compared(documents: pa.Table, facts: pa.Table) -> tuple[pa.Table, np.ndarray]:
    """The documents of a batch that have an id and are no copies of an earlier text, and their numbers."""
    table = _documents(_data(documents, DOCS))
    known = table.column("doc_id").is_valid().to_numpy() & ~np.isin(_addresses(table), _copies(facts))
    return table.filter(pa.array(known)), np.flatnonzero(known)


def batch_contexts(documents: pa.Table, facts: pa.Table, buckets: int, width: int, gram: int) -> pa.Table:
    """Per batch of documents: contexts of shared anchors to their buckets; of equal ones in a batch only the first document's.

    Contexts of hot anchors go as strings.
    """
    out = [_rows(SPANS, np.empty(0, int), [])]
    shared, hot = _numbers(_data(facts, REPEATED), np.uint64), _numbers(_data(facts, HOT), np.uint64)
    if not len(shared) or not documents.num_rows:
        return pa.Table.from_batches(out)
    home = documents.column("dest")[0].as_py()
    table, number = _compared(documents, facts)
    ids = table.column("doc_id").to_numpy()
    parts: dict[int, list[tuple]] = {}
    for low, _, data, bounds in text_slices(table.column("text")):
        value, start, end, owner = contexts(data, bounds, width, gram)
        bucket, key = _anchor_key(value, buckets)
        full = _full_key(bucket, key)
        at = np.minimum(np.searchsorted(shared, full), len(shared) - 1)
        hit = shared[at] == full
        bucket, key, start, end, owner, crowded = bucket[hit], key[hit], start[hit], end[hit], owner[hit], np.isin(full[hit], hot)
        if not len(key):
            continue
        doc = ids[low + owner]
        rep = _classes(data, start, end, doc)
        later = doc > doc[rep]
        place, size, which = start - bounds[owner], end - start, number[low + owner]
        if later.any():
            # Settled here; they pass through the bucket of their first context to the batch.
            spans = pa.table({"batch": np.full(later.sum(), home, np.int32), "doc": which[later].astype(np.int32), "start": place[later], "end": (place + size)[later]})
            out.append(_rows(SPANS, bucket[later][:1], [_pack(spans)]))
        cut = np.flatnonzero(~later & crowded)
        if len(cut):
            out += _hot_strings(data, start[cut], end[cut], place[cut], which[cut], doc[cut], home, buckets, width)
        sent = np.flatnonzero(~later & ~crowded)
        if len(sent):
            sent = sent[np.argsort(bucket[sent], kind="stable")]
            total = np.cumsum(size[sent])
            text = data[np.repeat(start[sent] - total + size[sent], size[sent]) + np.arange(total[-1])]
            columns = which[sent].astype(np.int32), place[sent].astype(np.int32), doc[sent], key[sent], size[sent]
            first = np.flatnonzero(np.diff(bucket[sent], prepend=-1))
            for one, two in zip(first, np.append(first[1:], len(sent)), strict=True):
                parts.setdefault(int(bucket[sent[one]]), []).append((*(c[one:two] for c in columns), text[total[one] - size[sent[one]] : total[two - 1]]))
    # One message to a bucket, not one of each slice: messages cost more than what is in them.
    packed = []
    for pieces in parts.values():
        which, place, doc, key, size, text = (np.concatenate(x) for x in zip(*pieces, strict=True))
        offsets = pa.py_buffer(np.concatenate(([0], np.cumsum(size))).astype(np.int32).tobytes())
        packed.append(_pack(pa.table({
            "batch": np.full(len(which), home, np.int32), "doc": which, "start": place, "doc_id": doc, "key": key,
            "text": pa.BinaryArray.from_buffers(pa.binary(), len(which), [None, offsets, pa.py_buffer(text.tobytes())]),
        })))
    if parts:
        out.append(_rows(CONTEXTS, np.array(list(parts)), packed))
    return pa.Table.from_batches(out)


class Suffixes:
    """Comparison of suffixes of ``data``, ``width`` bytes deep, by prefix polynomial hashes."""

    def __init__(self, data: np.ndarray, width: int):
        self.data, self.width, self.prefix = data, width, prefix_hashes(data)

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common extension, at most ``width``, by binary search."""
        low, high = np.zeros(len(a), np.int64), np.full(len(a), self.width)
        while (low < high).any():
            middle = (low + high + 1) // 2
            same = span_hashes(self.prefix, a, a + middle) == span_hashes(self.prefix, b, b + middle)
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        return low

    def before(self, a: np.ndarray, b: np.ndarray, or_equal: bool) -> np.ndarray:
        """Whether suffix ``a`` comes before ``b``."""
        out = np.full(len(a), or_equal)
        differ = np.flatnonzero(span_hashes(self.prefix, a, a + self.width) != span_hashes(self.prefix, b, b + self.width))
        a, b = a[differ], b[differ]
        length = self.common(a, b)
        out[differ] = self.data[a + length] < self.data[b + length]
        return out

    def sort(self, at: np.ndarray, segment: np.ndarray) -> np.ndarray:
        """``at`` sorted by suffix within each run of equal ``segment`` numbers: mergesort, all runs of a level at once.

        An element's place in the merged run is its own place plus the number of elements of the
        other run before it, found by binary search.
        """
        at = at.copy()
        first = np.flatnonzero(np.diff(segment, prepend=segment[0] - 1))
        size = np.diff(np.append(first, len(at)))
        begin, length = np.repeat(first, size), np.repeat(size, size)
        inner = np.arange(len(at)) - begin
        run = 1
        while run < size.max(initial=0):
            # Pairs of runs that are in order as they stand, as all runs of equal suffixes are, stay.
            lead = np.flatnonzero((inner % (2 * run) == 0) & (inner + run < length))
            apart = np.zeros(len(at), bool)
            apart[lead] = ~self.before(at[lead + run - 1], at[lead + run], True)
            busy = np.flatnonzero(apart[begin + inner - inner % (2 * run)])
            k, n, base = inner[busy], length[busy], begin[busy]
            block = k // run
            left = block % 2 == 0
            other = np.where(left, (block + 1) * run, (block - 1) * run)
            low = np.minimum(other, n)
            top = np.minimum(other + run, n)
            start = low.copy()
            while True:
                open_ = np.flatnonzero(low < top)
                if not len(open_):
                    break
                middle = (low[open_] + top[open_]) // 2
                mine, theirs = at[busy[open_]], at[base[open_] + middle]
                ahead = np.where(left[open_], self.before(theirs, mine, False), self.before(theirs, mine, True))
                low[open_] = np.where(ahead, middle + 1, low[open_])
                top[open_] = np.where(ahead, top[open_], middle)
            target = base + np.where(left, k, k - run) + (low - start)
            merged = at.copy()
            merged[target] = at[busy]
            at = merged
            run *= 2
        return at


def _removed(table: pa.Table, width: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context number, start, end) of spans to remove among the contexts of one bucket, as places in their documents."""
    text = table.column("text").combine_chunks().cast(pa.large_binary())
    (_, _, data, bounds), = list(text_slices(text, 1 << 62))
    start, end = bounds[:-1], bounds[1:]
    value, doc, place = (table.column(c).to_numpy() for c in ("key", "doc_id", "start"))
    place = place.astype(np.int64)
    rep = _classes(data, start, end, doc)
    later = doc > doc[rep]
    out = [(np.flatnonzero(later), place[later], place[later] + (end - start)[later])]
    heads = np.flatnonzero(rep == np.arange(len(rep)))
    heads = heads[np.argsort(value[heads], kind="stable")]
    crowd = np.zeros(len(heads), bool)
    twin = value[heads][1:] == value[heads][:-1]
    crowd[1:] |= twin
    crowd[:-1] |= twin
    heads = np.sort(heads[crowd])
    if len(heads):
        windows = end[heads] - start[heads] - width + 1
        total = np.cumsum(windows)
        owner = np.repeat(heads, windows)
        at = np.repeat(start[heads] - total + windows, windows) + np.arange(total[-1])
        # The k-gram's place in a string is part of the string: equal strings agree in it.
        byte_value = np.repeat(value, end - start)
        hits = np.flatnonzero((gram_hashes(data, gram) >> np.uint64(32)).astype(np.uint32) == byte_value[: len(data) - gram + 1])
        offset = hits[np.minimum(np.searchsorted(hits, at), len(hits) - 1)] - at
        # Buckets by first bytes keep the order of suffixes: the first eight and, where those reach
        # the common k-gram, the eight after it. The mergesort is left with what is equal so far.
        eight = eight_bytes(data)
        head = eight[at]
        after = np.where(offset < 8, eight[np.minimum(at + offset + gram, len(eight) - 1)], np.uint64(0))
        group = value[owner]
        by = np.lexsort((after, head, offset, group))
        at = at[by]
        fresh = np.zeros(len(at), bool)
        fresh[0] = True
        for key in (group, offset, head, after):
            key = key[by]
            fresh[1:] |= key[1:] != key[:-1]
        segment = np.cumsum(fresh)
        many = np.bincount(segment)[segment] > 1
        at, segment = at[many], segment[many]
        if len(at):
            suffixes = Suffixes(data, width)
            at = suffixes.sort(at, segment)
            near = segment[1:] == segment[:-1]
            equal = np.zeros(len(at), bool)
            equal[1:][near] = suffixes.common(at[:-1][near], at[1:][near]) >= width
            check = np.flatnonzero(equal)
            equal[check] = _equal_bytes(data, at[check - 1], at[check], np.full(len(check), width))
            owner = np.searchsorted(bounds, at, "right") - 1
            group = np.flatnonzero(~equal)
            smallest = np.repeat(np.minimum.reduceat(doc[owner], group), np.diff(np.append(group, len(at))))
            gone = doc[owner] > smallest
            at, owner = at[gone], owner[gone]
            order = np.argsort(at)
            at, owner = at[order], owner[order]
            if len(at):
                new = np.ones(len(at), bool)
                new[1:] = (at[1:] != at[:-1] + 1) | (owner[1:] != owner[:-1])
                low = np.flatnonzero(new)
                high = np.append(low[1:], len(at)) - 1
                head, low, high = owner[low], at[low], at[high] + width
                # Other places of the same document with an equal context lose the same spans.
                equals = np.flatnonzero(~later)
                equals = equals[np.argsort(rep[equals], kind="stable")]
                first = np.searchsorted(rep[equals], head, "left")
                times = np.searchsorted(rep[equals], head, "right") - first
                each = np.repeat(np.arange(len(head)), times)
                which = equals[np.repeat(first, times) + np.arange(len(each)) - np.repeat(np.cumsum(times) - times, times)]
                shift = place[which] - start[head[each]]
                out.append((which, low[each] + shift, high[each] + shift))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def settle_contexts(posted: DataFrame, buckets: int, width: int, gram: int) -> DataFrame:
    """To every batch, the spans its documents lose."""

    def work(batches):
        own: list[bytes] = []
        strings: list[bytes] = []
        for batch in batches:
            for kind, data in zip(batch.column("kind").to_pylist(), batch.column("data").to_pylist(), strict=True):
                if kind == CONTEXTS:
                    own.append(data)
                elif kind == STRINGS:
                    strings.append(data)
                else:
                    spans = _unpack([data])
                    yield from _post(SPANS, spans.column("batch").to_numpy(), spans)
        if own:
            table = _unpack(own)
            which, start, end = _removed(table, width, gram)
            home = table.column("batch").to_numpy()[which]
            yield from _post(SPANS, home, pa.table({"batch": home, "doc": table.column("doc").to_numpy()[which], "start": start, "end": end}))
        if strings:
            rows = np.concatenate([np.frombuffer(x, _string_type(width)) for x in strings])
            rows = rows[_has_earlier(rows["text"], rows["doc_id"])]
            start = rows["start"].astype(np.int64)
            yield from _post(SPANS, rows["batch"], pa.table({"batch": rows["batch"].copy(), "doc": rows["doc"].copy(), "start": start, "end": start + width}))

    return posted.repartitionById(buckets, F.col("dest")).mapInArrow(work, ROW)


RESULT = "doc_id long, n_bytes long, spans array<struct<start:long,length:long>>, kept binary"


def batch_results(documents: pa.Table, facts: pa.Table, width: int) -> pa.Table:
    """Per document of a batch: its bytes, the removed spans and what is kept."""
    ids, sizes, removed, kept = [], [], [], []
    if documents.num_rows:
        table = _documents(_data(documents, DOCS))
        copy = np.isin(_addresses(table), _copies(facts))
        pieces = _data(facts, SPANS)
        doc, low, high = (np.empty(0, np.int64),) * 3
        if pieces:
            spans = _unpack(pieces)
            doc, low, high = (spans.column(c).to_numpy().astype(np.int64) for c in ("doc", "start", "end"))
            by = np.argsort(doc, kind="stable")
            doc, low, high = doc[by], low[by], high[by]
        first = np.searchsorted(doc, np.arange(table.num_rows + 1))
        times, names = table.column("times").to_pylist(), table.column("doc_id").to_pylist()
        row = 0
        for _, _, data, bounds in text_slices(table.column("text")):
            for i in range(len(bounds) - 1):
                own = data[bounds[i] : bounds[i + 1]]
                change = np.zeros(len(own) + 1, np.int32)
                np.add.at(change, low[first[row] : first[row + 1]], 1)
                np.add.at(change, high[first[row] : first[row + 1]], -1)
                if copy[row] and len(own) >= width:
                    change[0] += 1
                gone = np.cumsum(change[:-1]) > 0
                edge = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0, append=0))
                ids += [names[row]] * times[row]
                sizes += [len(own)] * times[row]
                removed += [[{"start": a, "length": b - a} for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True)]] * times[row]
                kept += [own[~gone].tobytes()] * times[row]
                row += 1
    return pa.table({
        "doc_id": pa.array(ids, pa.int64()), "n_bytes": pa.array(sizes, pa.int64()),
        "spans": pa.array(removed, pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))), "kept": pa.array(kept, pa.binary()),
    })


def remove_repeats(docs: DataFrame, width: int = WIDTH, gram: int = GRAM, hot: int = HOT_DOCS) -> DataFrame:
    """``doc_id``, ``n_bytes``, removed ``spans`` and ``kept`` bytes for every row of ``docs`` (``doc_id``, ``text``).

    A byte goes if a string of ``width`` bytes over it also starts in a document with a smaller
    ``doc_id``, judged on the whole UTF-8 texts as given; matches never cross documents. NULL and
    empty texts keep their no bytes; texts under ``width`` bytes keep all. Rows of one ``doc_id`` do
    not count as earlier than each other. A NULL ``doc_id`` is neither earlier nor later than any.
    An empty table gives an empty result; other columns are not read. ``hot`` decides how strings
    meet, not which of them go.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    batches = max(1, -(-total // BATCH_BYTES))
    buckets = max(parallelism(spark), BUCKETS_PER_BATCH * batches)
    placed = rows.select("doc_id", F.xxhash64("doc_id", "text").alias("addr"), F.xxhash64(F.lit(1), "text", "doc_id").alias("addr2"), "text")
    placed = placed.withColumn("batch", F.pmod("addr", F.lit(batches)).cast("int"))
    known = placed.filter(F.col("doc_id").isNotNull())

    # Copies of a whole text need no comparison: everything in them starts in the first one too.
    digests = known.select("doc_id", "addr", "addr2", "batch", F.sha2("text", 256).alias("_sha"))
    firsts = digests.groupBy("_sha").agg(F.min("doc_id").alias("_first"))
    copies = lookup(digests, firsts, ["_sha"], "inner").filter(F.col("doc_id") > F.col("_first")).select("batch", "addr", "addr2").distinct()

    def post_copies(parts):
        for part in parts:
            addr = _addresses(part)
            lists = list(_split(part.column("batch").to_numpy()))
            if lists:
                yield _rows(COPIES, np.array([d for d, _ in lists]), [addr[r].tobytes() for _, r in lists])

    copied = stage(copies.mapInArrow(post_copies, ROW), "suffix-copies")
    # The packed documents are shuffled once: the three meetings read the same exchange.
    documents = post_documents(placed).groupBy("dest")
    anchors = documents.cogroup(copied.groupBy("dest")).applyInArrow(lambda d, f: batch_anchors(d, f, buckets, width, gram, hot), ROW)
    shared = answer_anchors(anchors, buckets, hot)
    facts = copied.unionByName(shared).groupBy("dest")
    posted = documents.cogroup(facts).applyInArrow(lambda d, f: batch_contexts(d, f, buckets, width, gram), ROW)
    spans = settle_contexts(posted, buckets, width, gram)
    facts = copied.unionByName(spans).groupBy("dest")
    return documents.cogroup(facts).applyInArrow(lambda d, f: batch_results(d, f, width), RESULT)


def digest(removed: DataFrame) -> DataFrame:
    """The per-document columns of the query."""
    lengths = F.aggregate("spans", F.lit(0).cast("long"), lambda done, s: done + s["length"])
    return removed.select("doc_id", "n_bytes", lengths.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
