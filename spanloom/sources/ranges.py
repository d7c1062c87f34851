"""Large text files whose records may hold their own separator, read by many tasks.

A file is read in byte ranges, each by its own task, as pieces that end in a separator: lines of a CSV,
or the stretches of a JSON document between closing brackets. Whether a piece ends a record depends on
whether a quoted text is open there, which depends on everything before it. So each range is first
summed up for both cases: is a quote open at its end, and how many brackets are. A running sum over
the ranges of a file then gives every range the state it begins in, and a second read cuts it into
records. Records that cross ranges come out as fragments, at most two a range, and are joined at the end.

Nothing but fragments and sums of ranges is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..operators.staging import stage

# Files above this size are read in ranges.
LARGE = 64 << 20
WHOLE, BEGUN, ENDED, INSIDE = 0, 1, 2, 3
SUMS = "file string, start long, flips long, opens0 long, opens1 long, stray0 boolean, stray1 boolean"
RECORD = "file string, start long, n long, kind int, depth long, text string"


def file_sizes(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``path`` and ``length`` of every file, from listing alone."""
    return spark.read.format("binaryFile").load(paths).select("path", "length")


def large_files(sizes: DataFrame, large: int) -> list[str]:
    """Paths of the files above ``large`` bytes: no more than the input has multiples of that."""
    return [r["path"] for r in sizes.filter(F.col("length") > large).select("path").collect()]


class Csv:
    """Lines; a record ends with a line that leaves no quote open. Doubled quotes cancel out."""

    separator = "\n"

    @staticmethod
    def outside(piece: str, quoted: int) -> tuple[int, int, bool]:
        """(quotes, 0, is a quote neither at the edge of a cell nor doubled) of a piece that begins inside quotes or not."""
        if '"' not in piece:
            return 0, 0, False
        parts = piece.rstrip("\r").split('"')
        last = len(parts) - 1
        stray = any(
            (i > 0 and s and not s.startswith(",")) or (i < last and s and not s.endswith(","))
            for i, s in enumerate(parts) if (i + quoted) % 2 == 0
        )
        return last, 0, stray

    @staticmethod
    def ends(quoted: int, depth: int) -> bool:
        return not quoted


class Json:
    """Stretches up to a closing bracket; a record ends with a bracket, outside texts, that leaves two open at most."""

    separator = "]"

    @staticmethod
    def outside(piece: str, quoted: int) -> tuple[int, int, bool]:
        """(quotes, brackets opened outside texts, False); a backslash takes the next character with it."""
        if "\\" in piece:
            piece = piece.replace("\\\\", "").replace('\\"', "")
        parts = piece.split('"')
        return len(parts) - 1, sum(s.count("[") for s in parts[quoted::2]), False

    @staticmethod
    def ends(quoted: int, depth: int) -> bool:
        return not quoted and depth <= 2


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[str]]]:
    """((file, start, further columns), pieces) of consecutive rows of one range."""
    for batch in batches:
        keys = batch.to_pydict()
        values = keys.pop("value")
        tags = list(zip(*keys.values(), strict=True))
        low = 0
        for high in range(1, len(values) + 1):
            if high == len(values) or tags[high] != tags[low]:
                yield tags[low], values[low:high]
                low = high


def _summed(kind: type) -> Callable:
    """For each range and both of its possible beginnings: quotes, net brackets, stray quotes."""

    def sums(batches):
        found: dict[tuple, list] = {}
        for (file, start), pieces in _runs(batches):
            state = found.setdefault((file, start), [0, 0, 0, False, False])
            for piece in pieces:
                for case in (0, 1):
                    flips, opens, stray = kind.outside(piece, (state[0] + case) % 2)
                    closes = (state[0] + case + flips) % 2 == 0
                    state[1 + case] += opens - closes
                    state[3 + case] |= stray
                state[0] += flips
        if found:
            yield pa.RecordBatch.from_pylist(
                [dict(zip(("file", "start", "flips", "opens0", "opens1", "stray0", "stray1"), (*k, *v), strict=True)) for k, v in found.items()],
                pa.schema([("file", pa.string()), ("start", pa.int64()), ("flips", pa.int64()), ("opens0", pa.int64()), ("opens1", pa.int64()),
                           ("stray0", pa.bool_()), ("stray1", pa.bool_())]),
            )

    return sums


def _cut(kind: type) -> Callable:
    """Records of each range from the state it begins in, with the number of open brackets before each."""

    def records(batches):
        range_, held = None, []
        out: list[tuple] = []
        schema = pa.schema([("file", pa.string()), ("start", pa.int64()), ("n", pa.int64()), ("kind", pa.int32()), ("depth", pa.int64()), ("text", pa.string())])

        def flush():
            rows = out.copy()
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema.names)

        def finish():
            if held:
                out.append((*range_, n, INSIDE if continued else BEGUN, before, "".join(held)))
                held.clear()

        for (file, start, quoted_, depth_), pieces in _runs(batches):
            if (file, start) != range_:
                finish()
                if quoted_ is None:
                    raise ValueError(f"{file} was cut into other ranges than at first: read it again")
                range_, n, quoted, depth, before = (file, start), 0, quoted_, depth_, depth_
                continued = not kind.ends(quoted, depth)
            for piece in pieces:
                flips, opens, _ = kind.outside(piece, quoted)
                quoted = (quoted + flips) % 2
                depth += opens - (not quoted)
                held.append(piece + kind.separator)
                if kind.ends(quoted, depth):
                    out.append((file, start, n, ENDED if continued else WHOLE, before, "".join(held)))
                    held.clear()
                    n, continued, before = n + 1, False, depth
            if len(out) >= 4096:
                yield flush()
        finish()
        if out:
            yield flush()

    return records


def cut_records(spark: SparkSession, paths: list[str], kind: type) -> DataFrame:
    """Records of files in a staged table: ``file``, ``start`` and ``n`` order them, ``depth`` is that before ``text``.

    A text ends in its separator. A file with stray quotes (in the middle of an unquoted cell) is refused, as no
    count of quotes tells its records. Both reads must cut the files alike, so leave
    ``spark.sql.files.maxPartitionBytes`` alone in between; other ranges are an error.
    """
    pieces = spark.read.option("lineSep", kind.separator).text(paths).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value"
    )
    sums = stage(pieces.mapInArrow(_summed(kind), SUMS), "range-sums")
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    quoted = F.coalesce(F.sum("flips").over(before), F.lit(0)) % 2
    opens = F.when(F.col("quoted") == 0, F.col("opens0")).otherwise(F.col("opens1"))
    states = (
        sums.withColumn("quoted", quoted)
        .withColumn("depth", F.coalesce(F.sum(opens).over(before), F.lit(0)))
        .withColumn("stray", F.when(F.col("quoted") == 0, F.col("stray0")).otherwise(F.col("stray1")))
    )
    bad = [r["file"] for r in states.filter("stray").select("file").distinct().limit(3).collect()]
    if bad:
        raise ValueError(f"quotes inside unquoted cells: read these files whole: {bad}")
    # One row a range: a small share of the bytes that one task reads.
    begun = pieces.join(F.broadcast(states.select("file", "start", "quoted", "depth")), ["file", "start"], "left")
    found = stage(begun.select("file", "start", "quoted", "depth", "value").mapInArrow(_cut(kind), RECORD), "records")
    fragments = found.filter(F.col("kind") != WHOLE)
    number = F.sum((F.col("kind") == BEGUN).cast("int")).over(Window.partitionBy("file").orderBy("start", "n"))
    place = F.struct("start", "n")
    joined = fragments.withColumn("record", number).groupBy("file", "record").agg(
        F.min(place).alias("place"), F.min_by("depth", place).alias("depth"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "n", "text"))), lambda f: f["text"]), "").alias("text"),
    )
    whole = found.filter(F.col("kind") == WHOLE).select("file", "start", "n", "depth", "text")
    return whole.unionByName(joined.select("file", "place.start", "place.n", "depth", "text"))
