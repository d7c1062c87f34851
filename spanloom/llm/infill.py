"""Fill-in-middle: a text's middle is moved behind its suffix, so that a model learns to fill gaps.

Texts are cut at token bounds into prefix, middle and suffix and written in one of two orders with
marks between, or left plain. Nothing is sliced text by text: for a whole batch of bytes, the cuts
give a difference array of how far every byte moves, its cumulative sum is each byte's shift, and
one scatter writes the outputs. Restoring finds the marks, builds the same kind of array
from them, and gathers the bytes back. Both go through a batch in blocks, so the arrays beside the
texts themselves stay small however long a text is. A text goes to the Python worker once, and rows go back
in portions as soon as they are made, so that no worker holds the outputs of a whole batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .common import unused, without

# Marks, the seed in front of the id, shares of plain and suffix-first texts in hundredths.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARK = 3
SEED = "1:"
TRANSFORMED, SUFFIX_FIRST = 90, 20
PLAIN, PSM, SPM = 0, 1, 2
FORMS = ["plain", "psm", "spm"]

PIECE = 4 << 20
BLOCK = 1 << 18
OUTPUTS = ["n", "form", "output", "prefix_chars", "middle_chars"]


def _is_letter(data: np.ndarray) -> np.ndarray:
    return ((data | 32) - np.uint8(97)) < 26


def blocks(size: int) -> Iterator[tuple[int, int]]:
    for low in range(0, size, BLOCK):
        yield low, min(low + BLOCK, size)


class Flags:
    """Ranks and places of the set bytes of a 0/1 array, with one count a block."""

    def __init__(self, flags: np.ndarray) -> None:
        self.flags = flags
        per_block = [int(np.count_nonzero(flags[low:high])) for low, high in blocks(len(flags))]
        self.before = np.concatenate([[0], np.cumsum(per_block, dtype=np.int64)])

    def rank(self, places: np.ndarray) -> np.ndarray:
        """Number of set bytes before each place."""
        out = np.empty(len(places), np.int64)
        owner = np.minimum(places // BLOCK, max(len(self.before) - 2, 0))
        for b in np.unique(owner):
            own, low = owner == b, b * BLOCK
            sums = np.concatenate([[0], np.cumsum(self.flags[low : low + BLOCK], dtype=np.int64)])
            out[own] = self.before[b] + sums[places[own] - low]
        return out

    def place(self, ranks: np.ndarray) -> np.ndarray:
        """Place of the set byte that has so many before it."""
        out = np.empty(len(ranks), np.int64)
        owner = np.searchsorted(self.before, ranks, side="right") - 1
        for b in np.unique(owner):
            own, low = owner == b, int(b) * BLOCK
            out[own] = low + np.flatnonzero(self.flags[low : low + BLOCK])[ranks[own] - self.before[b]]
        return out


def token_starts(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """1 for bytes that begin a token: a run of ASCII letters, or one other code point; texts are apart."""
    first = np.empty(len(data), np.uint8)
    carry = False
    for low, high in blocks(len(data)):
        block = data[low:high]
        letter = _is_letter(block)
        after_letter = np.concatenate([[carry], letter[:-1]])
        first[low:high] = ((block & 0xC0) != 0x80) & ~(letter & after_letter)
        carry = bool(letter[-1])
    begins = bounds[:-1][bounds[:-1] < bounds[1:]]
    first[begins] = 1
    return first


def shifts(size: int, places: np.ndarray, steps: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """(low, high, shift of each byte): running sums of the difference array with ``steps`` at ``places`` (ascending)."""
    carry = 0
    for low, high in blocks(size):
        a, b = np.searchsorted(places, [low, high])
        difference = np.zeros(high - low, np.int64)
        np.add.at(difference, places[a:b] - low, steps[a:b])
        difference[0] += carry
        moved = np.cumsum(difference)
        carry = int(moved[-1])
        yield low, high, moved


def _steps(starts: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Difference array entries that make the bytes from each of ``starts`` on move by ``moves``."""
    return np.diff(moves, prepend=0)


def spread(data: np.ndarray, bounds: np.ndarray, cut1: np.ndarray, cut2: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Output bytes and bounds of texts in ``data``; ``cut1`` and ``cut2`` are byte places in ``data``."""
    begin, end = bounds[:-1], bounds[1:]
    made = form != PLAIN
    out_bounds = np.concatenate([[0], np.cumsum(end - begin + 3 * MARK * made)])
    base = out_bounds[:-1]
    prefix, middle, suffix = cut1 - begin, cut2 - cut1, end - cut2
    # Where each part begins in the output.
    to_prefix = base + np.select([form == PSM, form == SPM], [MARK, 2 * MARK + suffix], 0)
    to_middle = np.where(made, base + 3 * MARK + prefix + suffix, base + prefix)
    to_suffix = np.select([form == PSM, form == SPM], [base + 2 * MARK + prefix, base + MARK], base + prefix + middle)
    starts = np.stack([begin, cut1, cut2], axis=1).ravel()
    moves = np.stack([to_prefix - begin, to_middle - cut1, to_suffix - cut2], axis=1).ravel()
    out = np.empty(int(out_bounds[-1]), np.uint8)
    for low, high, moved in shifts(len(data), starts, _steps(starts, moves)):
        out[np.arange(low, high) + moved] = data[low:high]
    for mark, at in ((PREFIX, to_prefix), (SUFFIX, to_suffix), (MIDDLE, to_middle)):
        for i, byte in enumerate(mark.encode()):
            out[at[made] - MARK + i] = byte
    return out, out_bounds


def _first_mark(out: np.ndarray, mark: str, low: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Place of the first ``mark`` of each text at or after ``low``."""
    a, b, c = mark.encode()
    found = [np.empty(0, np.int64)]
    for at, high in blocks(max(len(out) - 2, 0)):
        found.append(at + np.flatnonzero((out[at:high] == a) & (out[at + 1 : high + 1] == b) & (out[at + 2 : high + 2] == c)))
    places = np.concatenate(found)
    at = np.searchsorted(places, low)
    hit = np.where(at < len(places), places[np.minimum(at, len(places) - 1)] if len(places) else -1, -1)
    if (hit < low).any() or (hit + MARK > bounds).any():
        raise ValueError(f"an output has no {mark}")
    return hit


def gathered(out: np.ndarray, bounds: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts, and their bounds, that ``spread`` made ``out`` from."""
    base, end = bounds[:-1], bounds[1:]
    made = form != PLAIN
    own = np.flatnonzero(made)
    first, second = np.full(len(form), -1), np.full(len(form), -1)
    for kind, inner in ((PSM, SUFFIX), (SPM, PREFIX)):
        texts = np.flatnonzero(form == kind)
        first[texts] = _first_mark(out, inner, base[texts] + MARK, end[texts])
    second[own] = _first_mark(out, MIDDLE, first[own] + MARK, end[own])
    psm, spm = form == PSM, form == SPM
    from_prefix = np.select([psm, spm], [base + MARK, first + MARK], base)
    prefix = np.select([psm, spm], [first - base - MARK, second - first - MARK], end - base)
    from_suffix = np.select([psm, spm], [first + MARK, base + MARK], end)
    suffix = np.select([psm, spm], [second - first - MARK, first - base - MARK], 0)
    from_middle = np.where(made, second + MARK, end)
    middle = np.where(made, end - second - MARK, 0)
    text_bounds = np.concatenate([[0], np.cumsum(prefix + middle + suffix)])
    begin = text_bounds[:-1]
    starts = np.stack([begin, begin + prefix, begin + prefix + middle], axis=1).ravel()
    moves = np.stack([from_prefix - begin, from_middle - begin - prefix, from_suffix - begin - prefix - middle], axis=1).ravel()
    data = np.empty(int(text_bounds[-1]), np.uint8)
    for low, high, moved in shifts(len(data), starts, _steps(starts, moves)):
        data[low:high] = out[np.arange(low, high) + moved]
    return data, text_bounds


def pieces(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row, bytes, bounds) of consecutive texts of about ``PIECE`` bytes, one text at least."""
    texts = texts.cast(pa.large_string()) if texts.type != pa.large_string() else texts
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] is not None else np.empty(0, np.uint8)
    low = 0
    while low < len(texts):
        high = max(int(np.searchsorted(offsets, offsets[low] + PIECE, side="right")) - 1, low + 1)
        yield low, high, data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
        low = high


def _strings(parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.Array:
    arrays = [
        pa.Array.from_buffers(pa.large_string(), len(bounds) - 1, [None, pa.py_buffer(np.ascontiguousarray(bounds, np.int64)), pa.py_buffer(data)])
        for data, bounds in parts
    ]
    return pa.concat_arrays(arrays).cast(pa.string()) if arrays else pa.array([], pa.string())


def portions(batch: pa.RecordBatch, column: int) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Consecutive rows of ``batch`` with about ``PIECE`` bytes in ``column``, and these texts, NULL as an empty one."""
    texts = batch.column(column)
    for low, high, _, _ in pieces(texts):
        own = texts.slice(low, high - low)
        yield batch.slice(low, high - low), pc.fill_null(own, "") if own.null_count else own


def cut_texts(texts: pa.Array, form: np.ndarray, h1: np.ndarray, h2: np.ndarray) -> pa.RecordBatch:
    """``OUTPUTS`` of non-null ``texts`` in the given forms; the cuts are ``h1`` and ``h2`` modulo tokens + 1."""
    counts, outs, prefixes, middles = [], [], [], []
    for low, high, data, bounds in pieces(texts):
        own = form[low:high]
        tokens = Flags(token_starts(data, bounds))
        before = tokens.rank(bounds)
        n = np.diff(before)
        k1, k2 = h1[low:high] % (n + 1), h2[low:high] % (n + 1)
        cuts = []
        for k in (np.minimum(k1, k2), np.maximum(k1, k2)):
            cut = bounds[1:].copy()
            inside = k < n
            cut[inside] = tokens.place(before[:-1][inside] + k[inside])
            cuts.append(cut)
        del tokens
        outs.append(spread(data, bounds, *cuts, own))
        points = Flags(((data & 0xC0) != 0x80).view(np.uint8))
        at = [points.rank(p) for p in (bounds[:-1], *cuts)]
        counts.append(n)
        prefixes.append(at[1] - at[0])
        middles.append(at[2] - at[1])
    joined = lambda xs: np.concatenate([np.empty(0, np.int64), *xs])
    plain = form == PLAIN
    return pa.RecordBatch.from_arrays([
        pa.array(joined(counts)), pa.array(FORMS).take(pa.array(form)), _strings(outs),
        pa.array(joined(prefixes), mask=plain), pa.array(joined(middles), mask=plain),
    ], OUTPUTS)


def draws(key: Column) -> list[Column]:
    """Four numbers below 2^32 from a hash of the key; a NULL key is the empty one."""
    digest = F.sha2(F.concat(F.lit(SEED), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def _text_column(df: DataFrame, name: str) -> int | None:
    """Number of the column ``name`` (in any case) of ``df`` if it is the only one and a string, which then need not be sent as text again."""
    found = [i for i, f in enumerate(df.schema.fields) if f.name.lower() == name.lower()]
    return found[0] if len(found) == 1 and df.schema.fields[found[0]].dataType == StringType() else None


def fill_in_middle(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """All rows and columns of ``docs`` with ``n`` (tokens), ``form``, ``output``, ``prefix_chars`` and ``middle_chars``.

    Input columns of those names are replaced. A NULL text is empty. Empty texts, texts that hold a
    mark and a tenth of the others stay plain, without prefix and middle. Cuts depend on the key alone, so equal
    rows come out equal. An empty table gives an empty result. Texts of any length are cut whole.
    """
    rows = without(docs, *OUTPUTS)
    names = rows.columns
    full = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    h1, h2, h3, h4 = draws(F.col(f"`{key}`"))
    marked = full.contains(PREFIX) | full.contains(SUFFIX) | full.contains(MIDDLE)
    form = F.when((full == "") | marked | (h3 % 100 >= TRANSFORMED), PLAIN).when(h4 % 100 < SUFFIX_FIRST, SPM).otherwise(PSM)
    at = _text_column(rows, text)
    extra = {unused(rows, f"_{name}"): column for name, column in {"form": form, "h1": h1, "h2": h2, "full": full}.items() if name != "full" or at is None}
    place = len(names) + 3 if at is None else at

    def made(batches):
        for batch in batches:
            for own, texts in portions(batch, place):
                forms, a, b = (own.column(len(names) + i) for i in range(3))
                out = cut_texts(texts, forms.to_numpy().astype(np.int64), a.to_numpy(), b.to_numpy())
                yield pa.RecordBatch.from_arrays([*[own.column(i) for i in range(len(names))], *out.columns], [*names, *OUTPUTS])

    added = [StructField("n", LongType()), StructField("form", StringType()), StructField("output", StringType()),
             StructField("prefix_chars", LongType()), StructField("middle_chars", LongType())]
    return rows.withColumns(extra).mapInArrow(made, StructType([*rows.schema.fields, *added]))


def restore(rows: DataFrame, output: str = "output", form: str = "form") -> DataFrame:
    """``rows`` with ``restored``, the text that each ``output`` of a ``form`` was made from; such an input column is replaced.

    A NULL output is restored as empty; an output without the marks of its form is an error.
    """
    kept = without(rows, "restored")
    names = kept.columns
    number = F.array_position(F.array(*[F.lit(f) for f in FORMS]), F.coalesce(F.col(f"`{form}`"), F.lit(FORMS[PLAIN]))).cast("int") - 1
    at = _text_column(kept, output)
    extra = {unused(kept, "_form"): number}
    if at is None:
        extra[unused(kept, "_full")] = F.coalesce(F.col(f"`{output}`"), F.lit(""))
    place = len(names) + 1 if at is None else at

    def back(batches):
        for batch in batches:
            for own, texts in portions(batch, place):
                forms = own.column(len(names)).to_numpy().astype(np.int64)
                parts = [gathered(data, bounds, forms[low:high]) for low, high, data, bounds in pieces(texts)]
                yield pa.RecordBatch.from_arrays([*[own.column(i) for i in range(len(names))], _strings(parts)], [*names, "restored"])

    return kept.withColumns(extra).mapInArrow(back, StructType([*kept.schema.fields, StructField("restored", StringType())]))


def digest(docs: DataFrame) -> DataFrame:
    """Digests of the outputs of ``docs`` (``doc_id``, ``text``) and of the texts restored from them."""
    found = restore(fill_in_middle(docs.select("doc_id", "text")).drop("text"))
    return found.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2("restored", 256).alias("restored_sha256"),
    )
