"""Quality rules whose thresholds follow the corpus.

Each document is measured in whole numbers. Per language and source, a quantile sketch of every
measure is kept: counts by bucket, where a bucket holds values that agree in their first six bits, so
that a quantile is known to within a 32nd of its value. Sketches merge by adding counts, so the
sketch of a language is the sum of those of its sources. A document goes if a measure lies
beyond the outer fence of its group: ``FENCE`` times the quartile spread outside the quartiles. A
group of fewer than ``MIN_DOCS`` documents uses the sketch of its language, and that failing, of all.

Everything is whole-number arithmetic on built-in functions, so merging order changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..operators.lookup import lookup
from ..operators.staging import stage
from .common import WORD, bind, null_safe_key, without

# Blanks between words, characters that count as symbols, the window of repeated words.
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8

MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30
MIN_DOCS = 200
FENCE = 3
MANTISSA_BITS = 6
MILLION = 1_000_000

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
OUTPUTS = [*BASE, "base_failed", "failed_rules", "kept"]


class Rule(NamedTuple):
    """A share ``part`` of ``whole`` in millionths; ``slack`` is the least spread a fence is built on."""

    part: str
    whole: str
    slack: int
    both_ends: bool = False


RULES = {
    "symbols": Rule("n_symbols", "word_chars", 10_000),
    "capitals": Rule("n_upper", "word_chars", 30_000),
    "word_length": Rule("word_chars", "n_words", 500_000, both_ends=True),
    "word_runs": Rule("n_word_runs", "n_words", 20_000),
    "repeated_lines": Rule("n_dup_lines", "n_lines", 150_000),
    "repeated_words": Rule("n_repeat_words", "n_words", 80_000),
}


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Number of words inside windows of ``window`` words that occur twice or more in ``words``.

    Windows meet by hash, in sorted order, and count where their words are equal. Texts whose
    hashes are all different, which is most of them, are not sorted.
    """

    def same(w: Column, a: Column, b: Column) -> Column:
        return F.coalesce((a["h"] == b["h"]) & (F.slice(w, a["at"] + 1, window) == F.slice(w, b["at"] + 1, window)), F.lit(False))

    def covered(at: Column) -> Column:
        reach = F.transform(at, lambda x, i: F.least(F.lit(window), F.coalesce(F.get(at, i + 1) - x, F.lit(window))))
        return F.aggregate(reach, F.lit(0).cast("long"), lambda done, x: done + x)

    def places(w: Column, s: Column) -> Column:
        twice = F.filter(s, lambda x, i: same(w, x, F.get(s, i - 1)) | same(w, x, F.get(s, i + 1)))
        return F.sort_array(F.transform(twice, lambda x: x["at"]))

    def among(w: Column, hashes: Column) -> Column:
        placed = F.sort_array(F.transform(hashes, lambda x, i: F.struct(x.alias("h"), i.alias("at"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(
            bind(placed, lambda s: bind(places(w, s), covered))
        )

    def count(w: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(w) - window + 1)
        hashes = F.transform(starts, lambda i: F.xxhash64(F.slice(w, i, window)))
        return F.when(F.size(w) <= window, F.lit(0).cast("long")).otherwise(bind(hashes, lambda h: among(w, h)))

    return bind(words, count)


def measured(text: Column) -> dict[str, Column]:
    """Whole-number measures of a text by name."""
    full = F.coalesce(text, F.lit(""))
    words = F.regexp_extract_all(full, F.lit(WORD), F.lit(0))
    lines = F.filter(F.split(full, "\n"), lambda x: F.translate(x, BLANKS, "") != "")
    sized = bind(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup")))
    runs = lambda w: F.size(F.filter(w, lambda x, i: x == F.get(w, i - 1)))
    counted = bind(words, lambda w: F.struct(
        F.size(w).cast("long").alias("n"), repeated_words(w).alias("repeated"), runs(w).cast("long").alias("runs"),
    ))
    length = lambda c: F.char_length(c).cast("long")
    return {
        "_words": counted, "_lines": sized,
        "word_chars": length(F.translate(full, BLANKS, "")),
        "n_symbols": length(full) - length(F.translate(full, SYMBOLS, "")),
        "n_upper": length(full) - length(F.regexp_replace(full, r"\p{Lu}", "")),
    }


def measure(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """``docs`` as the struct ``row``, with the measures of each text and the key of its group."""
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    keys = {"lang_key": null_safe_key(f"row.{lang}"), "group_key": null_safe_key(f"row.{lang}", f"row.{source}")}
    found = own.withColumns(measured(F.col(f"row.{text}")) | keys)
    n_words, repeated = F.col("_words.n"), F.col("_words.repeated")
    return found.select(
        "row", "lang_key", "group_key", n_words.alias("n_words"), "word_chars", "n_symbols", "n_upper",
        F.col("_words.runs").alias("n_word_runs"), F.col("_lines.n").alias("n_lines"), F.col("_lines.dup").alias("n_dup_lines"), repeated.alias("n_repeat_words"),
        ((n_words < MIN_WORDS) | (100 * repeated > MAX_REPEATED_PERCENT * n_words)).alias("base_failed"),
    )


def share(rule: Rule) -> Column:
    """The rule's value in millionths, rounded down; 0 where there is no whole."""
    part, whole = F.col(rule.part), F.col(rule.whole)
    return F.when(whole > 0, F.call_function("div", part * MILLION, whole)).otherwise(F.lit(0).cast("long"))


def bucket(value: Column) -> Column:
    """Number of the bucket of a whole ``value`` from 0 up; buckets are ordered as their values."""
    beyond = F.greatest(F.length(F.bin(value)) - MANTISSA_BITS, F.lit(0))
    return F.call_function("shiftright", value, beyond) + beyond * (1 << (MANTISSA_BITS - 1))


def edges(code: Column) -> tuple[Column, Column]:
    """Least and largest value of a bucket."""
    half = 1 << (MANTISSA_BITS - 1)
    beyond = F.greatest(F.call_function("div", code, F.lit(half)) - 1, F.lit(0)).cast("int")
    low = code - beyond * half
    return F.call_function("shiftleft", low, beyond), F.call_function("shiftleft", low + 1, beyond) - 1


def sketches(rows: DataFrame) -> DataFrame:
    """Counts by language, group, rule and bucket of the documents that the base rules pass."""
    values = F.array(*[F.struct(F.lit(name).alias("rule"), bucket(share(rule)).alias("code")) for name, rule in RULES.items()])
    return (
        rows.filter(~F.col("base_failed")).select("lang_key", "group_key", F.explode(values).alias("v"))
        .groupBy("lang_key", "group_key", F.col("v.rule").alias("rule"), F.col("v.code").alias("code")).agg(F.count(F.lit(1)).alias("n"))
    )


def merged(sketch: DataFrame) -> DataFrame:
    """Sketches of every group, every language and all documents, by ``level`` (2, 1, 0) and ``key``."""
    levels = F.array(
        F.struct(F.lit(2).alias("level"), F.col("group_key").alias("key")), F.struct(F.lit(1).alias("level"), F.col("lang_key").alias("key")),
        F.struct(F.lit(0).alias("level"), F.lit("").alias("key")),
    )
    return (
        sketch.select(F.explode(levels).alias("l"), "rule", "code", "n")
        .groupBy("l.level", "l.key", "rule", "code").agg(F.sum("n").alias("n"))
    )


def fences(sketch: DataFrame) -> DataFrame:
    """``level``, ``key``, ``rule``, ``docs`` and the fence ``low`` .. ``high`` of each merged sketch.

    A sketch has some 2,000 buckets at most, so one window holds it.
    """
    by = Window.partitionBy("level", "key", "rule")
    low, high = edges(F.col("code"))
    counted = merged(sketch).withColumns({
        "upto": F.sum("n").over(by.orderBy("code")), "docs": F.sum("n").over(by), "low_edge": low, "high_edge": high,
    })
    slack = F.create_map(*[F.lit(x) for name, rule in RULES.items() for x in (name, rule.slack)])
    two_sided = F.col("rule").isin([name for name, rule in RULES.items() if rule.both_ends])
    quartiles = counted.groupBy("level", "key", "rule").agg(
        F.first("docs").alias("docs"),
        F.min(F.when(4 * F.col("upto") >= F.col("docs"), F.col("low_edge"))).alias("q1"),
        F.min(F.when(4 * F.col("upto") >= 3 * F.col("docs"), F.col("high_edge"))).alias("q3"),
    )
    reach = FENCE * F.greatest(F.col("q3") - F.col("q1"), F.element_at(slack, F.col("rule")))
    return quartiles.select(
        "level", "key", "rule", "docs", F.when(two_sided, F.col("q1") - reach).otherwise(F.lit(0)).alias("low"), (F.col("q3") + reach).alias("high"),
    )


def thresholds(rows: DataFrame) -> DataFrame:
    """``group_key`` -> ``limits`` (rule -> low, high), from the nearest sketch of ``MIN_DOCS`` documents or of all."""
    sketch = stage(sketches(rows), "quantile-sketches")
    found = stage(fences(sketch), "fences").filter((F.col("docs") >= MIN_DOCS) | (F.col("level") == 0))
    keys = F.array(
        F.struct(F.lit(2).alias("level"), F.col("group_key").alias("key")), F.struct(F.lit(1).alias("level"), F.col("lang_key").alias("key")),
        F.struct(F.lit(0).alias("level"), F.lit("").alias("key")),
    )
    groups = sketch.select("group_key", "lang_key").distinct().select("group_key", F.explode(keys).alias("l")).select("group_key", "l.*")
    limits = lookup(groups, found.groupBy("level", "key").agg(
        F.map_from_entries(F.collect_list(F.struct("rule", F.struct("low", "high")))).alias("limits")
    ), ["level", "key"], "inner")
    return limits.groupBy("group_key").agg(F.max_by("limits", "level").alias("limits"))


def judge(rows: DataFrame) -> DataFrame:
    """Rows of ``measure`` (a table that can be read twice) with ``failed_rules`` and ``kept``."""
    limits = F.col("limits")

    def broken(name: str, rule: Rule) -> Column:
        fence = F.element_at(limits, F.lit(name))
        return F.when((share(rule) < fence["low"]) | (share(rule) > fence["high"]), F.lit(name))

    failed = F.array_compact(F.array(*[broken(name, rule) for name, rule in RULES.items()]))
    found = lookup(rows, thresholds(rows), ["group_key"]).withColumn("failed_rules", failed)
    return found.withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))


def apply_rules(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """All rows and columns of ``docs`` with their measures, ``base_failed``, ``failed_rules`` and ``kept``.

    Input columns of those names are replaced; any other name may occur. A NULL or empty text has
    no words and fails the base rules. A NULL language or source is a value of its own. Repeated rows
    are measured and judged each. An empty table gives an empty result. Texts are measured whole.
    """
    measures = stage(measure(without(docs, *OUTPUTS), text, lang, source), "quality-measures")
    return judge(measures).select("row.*", *OUTPUTS)
