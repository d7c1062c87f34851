"""Queries ``opN_<name>`` over the given tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import chat, classify, codes, contamination, infill, jaccard, lines, mixing, neighbours, rules, sharding, suffixes
from ..operators.staging import stage
from .common import held_out, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(plan):
    QUERIES[plan.__name__] = plan
    return plan


@query
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    docs = table(spark, sf_dir, "documents")
    return classify.score_quality(docs, classify.fit_quality(docs, table(spark, sf_dir, "labels")))


@query
def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix of all documents takes from each."""
    return mixing.Mix(table(spark, sf_dir, "documents")).taken().select("doc_id", "size", "source_size", "target", "taken")


@query
def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one whose turns hold marks of common templates, formatted and read back."""
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    marked = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    return chat.digest(chat.format_conversations(given.unionByName(marked)))


ORACLE_SQL["op3_chat"] = r"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all
  select -1, turn, case turn when 0 then 'user' else 'assistant' end, '</s>[INST] ok [/INST]' from range(2) r(turn)
), measured as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as n,
    len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) + 4 as tokens,
    3 + length(role) + length(role) - length(replace(replace(role, '\', ''), chr(10), ''))
      + len(regexp_extract_all(role, '</?s>')) + 1 + length(text) + len(regexp_extract_all(text, '</?s>')) + 5 as chars
  from turns
), placed as (
  select *, sum(tokens) over (partition by conv_id order by n) - tokens as start_token from measured
), cells as (
  select *, greatest(384 - system_tokens, 1) as room, start_token // greatest(greatest(384 - system_tokens, 1) * 3 // 4, 1) as cell from (
    select *, first_value(case when role = 'system' then tokens else 0 end) over (partition by conv_id order by n) as system_tokens from placed)
), windowed as (
  select *, 2 * cell + case when last_start > first_start and start_token = last_start and stop - first_start > room then 1 else 0 end as win from (
    select *, min(start_token) over c as first_start, max(start_token) over c as last_start, max(start_token + tokens) over c as stop
    from cells window c as (partition by conv_id, cell))
), windows as (
  select *, lag(win) over (partition by conv_id order by win) as previous from (
    select conv_id, win, min(start_token) as win_start, 512 - max(system_tokens) - sum(tokens) as free from windowed group by conv_id, win)
), repeated as (
  select t.conv_id, sum(chars) as repeated_chars from windows w join windowed t on t.conv_id is not distinct from w.conv_id and t.win = w.previous
  where win_start - start_token <= least(128, free) and not (n = 1 and role = 'system') group by t.conv_id
), per_conv as (
  select conv_id, count(*)::bigint as n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' order by n)) as turns_sha256,
    coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
    sha256(coalesce(string_agg(text, '' order by n) filter (role = 'assistant'), '')) as loss_sha256,
    sum(chars) as new_chars,
    coalesce(sum(chars) filter (n = 1 and role = 'system'), 0) * (count(distinct win) - 1) as system_chars
  from windowed group by conv_id
)
select p.conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, (new_chars + coalesce(repeated_chars, 0) + system_chars)::bigint as formatted_chars
from per_conv p left join repeated r on r.conv_id is not distinct from p.conv_id
"""


@query
def op4_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of all documents that copy or edit a benchmark item."""
    return contamination.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    docs = table(spark, sf_dir, "documents")
    found = classify.identify_language(docs.select("doc_id", "text"), classify.fit_language(docs))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")


@query
def op6_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of all vectors to every twentieth one."""
    return neighbours.nearest(table(spark, sf_dir, "embeddings"))


@query
def op7_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages without the lines that more than the set share of their host's pages hold."""
    kept = lines.drop_boilerplate(table(spark, sf_dir, "pages"))
    return kept.select("page_id", "host", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


ORACLE_SQL["op7_lines"] = rf"""
with lined as (
  select page_id, row_number() over () as row_id, lower(coalesce(regexp_extract(url, '{lines.HOST}', 1), '')) as host,
    list_filter(list_transform(regexp_split_to_array(regexp_replace(regexp_replace(regexp_replace(coalesce(html, ''),
      '{lines.INVISIBLE}', '', 'g'), '{lines.BLOCK_TAG}', chr(10), 'g'), '{lines.OTHER_TAG}', '', 'g'), '[\r\n]+'),
      lambda x: trim(x, ' ' || chr(9) || chr(11) || chr(12))), lambda x: x <> '') as lines
  from pages
), totals as (select host, count(*) as pages from lined group by host
), seen as (
  select host, line, count(*) as pages_with from (select host, unnest(list_distinct(lines)) as line from lined) group by host, line
), frequent as (
  select host, list(line) as dropped from seen join totals using (host)
  where pages_with > {lines.RATIO} * pages and pages_with >= {lines.MIN_PAGES} group by host
), kept as (
  select page_id, host, lines, list_filter(lines, lambda x: not list_contains(coalesce(dropped, []), x)) as kept
  from lined left join frequent using (host)
)
select page_id, host, len(lines)::bigint as n_lines, (len(lines) - len(kept))::bigint as n_removed,
  sha256(coalesce(array_to_string(kept, chr(10)), '')) as kept_sha256
from kept
"""


@query
def op8_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents under links of 85 hundredths of their four-word shingles."""
    return jaccard.jaccard_classes(table(spark, sf_dir, "documents"), 4, 85)


@query
def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of equal row counts."""
    return sharding.digest(sharding.shard_rows(table(spark, sf_dir, "documents"), 16))


@query
def op10_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of all documents without strings of 50 bytes that an earlier one holds."""
    return suffixes.digest(suffixes.remove_repeats(table(spark, sf_dir, "documents")))


@query
def op11_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents judged by the base rules and by the fences of their language and source."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    measures = stage(rules.measure(docs).withColumn("row", F.struct("row.doc_id")), "quality-measures")
    return rules.judge(measures).select("row.doc_id", *rules.BASE, "base_failed", "kept")


def _rules_sql() -> str:
    """Word windows and lines are unnested here, and quartiles are taken from the buckets' running counts."""
    half = 1 << (rules.MANTISSA_BITS - 1)
    blanks = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    shares = " union all ".join(
        f"select row_id, lang, source, '{name}' as rule, case when {r.whole} > 0 then {r.part} * {rules.MILLION} // {r.whole} else 0 end as v, "
        f"{r.slack} as slack, {str(r.both_ends).lower()} as two_sided from measured where not base_failed"
        for name, r in rules.RULES.items()
    )
    return rf"""
with doc as (
  select row_number() over () as row_id, doc_id, lang, source, coalesce(text, '') as t,
    regexp_extract_all(coalesce(text, ''), '[^ 	-
]+') as w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: translate(x, {blanks}, '') <> '') as l
  from documents
), windows as (
  select row_id, i, array_to_string(w[i:i + {rules.WINDOW - 1}], ' ') as win
  from (select row_id, w, unnest(range(1, len(w) - {rules.WINDOW - 2})) as i from doc where len(w) >= {rules.WINDOW})
), twice as (
  select row_id, i from (select row_id, i, count(*) over (partition by row_id, win) as n from windows) where n > 1
), repeated as (
  select row_id, count(distinct pos)::bigint as n from (select row_id, unnest(range(i, i + {rules.WINDOW})) as pos from twice) group by row_id
), measured as (
  select row_id, doc_id, lang, source, len(w)::bigint as n_words, length(translate(t, {blanks}, ''))::bigint as word_chars,
    (length(t) - length(translate(t, '{rules.SYMBOLS}', '')))::bigint as n_symbols,
    (length(t) - length(regexp_replace(t, '\p{{Lu}}', '', 'g')))::bigint as n_upper,
    len(l)::bigint as n_lines, (len(l) - len(list_distinct(l)))::bigint as n_dup_lines,
    len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1]))::bigint as n_word_runs,
    coalesce(n, 0)::bigint as n_repeat_words,
    len(w) < {rules.MIN_WORDS} or 100 * coalesce(n, 0) > {rules.MAX_REPEATED_PERCENT} * len(w) as base_failed
  from doc left join repeated using (row_id)
), shares as ({shares}
), coded as (
  select *, greatest(length(bin(v)) - {rules.MANTISSA_BITS}, 0) as beyond from shares
), bucketed as (
  select *, (v >> beyond) + beyond * {half} as code, (v >> beyond) << beyond as low_edge, (((v >> beyond) + 1) << beyond) - 1 as high_edge from coded
), leveled as (
  select 2 as level, lang, source, rule, code, low_edge, high_edge, slack, two_sided from bucketed
  union all select 1, lang, null, rule, code, low_edge, high_edge, slack, two_sided from bucketed
  union all select 0, null, null, rule, code, low_edge, high_edge, slack, two_sided from bucketed
), summed as (
  select level, lang, source, rule, code, any_value(low_edge) as low_edge, any_value(high_edge) as high_edge, any_value(slack) as slack,
    any_value(two_sided) as two_sided, count(*) as n from leveled group by all
), counted as (
  select *, sum(n) over (partition by level, lang, source, rule order by code) as upto, sum(n) over (partition by level, lang, source, rule) as docs from summed
), quartiles as (
  select level, lang, source, rule, any_value(docs) as docs, any_value(slack) as slack, any_value(two_sided) as two_sided,
    min(low_edge) filter (4 * upto >= docs) as q1, min(high_edge) filter (4 * upto >= 3 * docs) as q3
  from counted group by level, lang, source, rule
), fences as (
  select *, {rules.FENCE} * greatest(q3 - q1, slack) as reach from quartiles where docs >= {rules.MIN_DOCS} or level = 0
), nearest as (
  select s.row_id, s.rule, s.v, arg_max(case when f.two_sided then f.q1 - f.reach else 0 end, f.level) as low, arg_max(f.q3 + f.reach, f.level) as high
  from shares s join fences f on f.rule = s.rule and (f.level = 0 or f.lang is not distinct from s.lang)
    and (f.level < 2 or f.source is not distinct from s.source)
  group by s.row_id, s.rule, s.v
), broken as (select distinct row_id from nearest where v < low or v > high)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and row_id not in (select row_id from broken) as kept
from measured
"""


ORACLE_SQL["op11_rules"] = _rules_sql()


@query
def op12_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all vectors under codebooks learned from all of them."""
    found = codes.compressed(table(spark, sf_dir, "embeddings"))
    return found.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


@query
def op13_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents cut for fill-in-middle, and restored from the outputs."""
    return infill.digest(table(spark, sf_dir, "documents"))
