"""Sharding, mixing, chat windows and line dedup."""

from __future__ import annotations

import hashlib
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from spanloom.llm import chat, lines, mixing, sharding
from spanloom.llm.common import exclusive_offsets, explode_range, permuted
from spanloom.llm.queries import ORACLE_SQL, QUERIES
from spanloom.operators.staging import stage
from tests.compare import connect, oracle_result, spark_result, type_differences

from .brute import WORD
from .conftest import SMALL


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    df, con = QUERIES[name](spark, SMALL), connect(SMALL)
    assert spark_result(df) == oracle_result(con, ORACLE_SQL[name])
    assert type_differences(df, con, ORACLE_SQL[name]) == []


def test_offsets_and_ranges(spark):
    sizes = spark.range(0, 5000).select(F.col("id").alias("i"), (F.col("id") % 7).alias("v"), (F.col("id") % 2).alias("g"))
    got = {r.i: r.o for r in exclusive_offsets(sizes, ["g"], "i", "v", "o", fan=64).collect()}
    total = Counter()
    for i in range(5000):
        assert got[i] == total[i % 2]
        total[i % 2] += i % 7
    many = explode_range(spark.createDataFrame([(1, 10000), (2, 0), (3, 1)], "k long, c long"), "c", "j", 8)
    assert Counter(r.k for r in many.collect()) == {1: 10000, 3: 1}
    for n in (1, 2, 12, 97, 4096):
        places = spark.range(n).select(permuted(F.col("id"), F.lit(n), F.lit(987654321)).alias("p")).collect()
        assert sorted(p.p for p in places) == list(range(n))


def test_fisher_yates(spark):
    rows = spark.range(200).select(F.col("id"), sharding.fisher_yates((F.col("id") + 1).cast("int"), [F.lit(3), F.col("id")]).alias("p")).collect()
    assert all(sorted(r.p) == list(range(r.id + 1)) for r in rows)
    three = spark.range(6000).select(sharding.fisher_yates(F.lit(3), [F.col("id")]).alias("p")).groupBy("p").count().collect()
    assert len(three) == 6 and all(850 < r["count"] < 1150 for r in three)


def check_shards(rows, shards):
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots[i]) for i in range(shards)]
    assert max(sizes) - min(sizes) <= 1


def test_sharding(spark, odd_docs, no_docs):
    out = sharding.shard_rows(odd_docs, 4, bucket_rows=8)
    assert out.columns == [c for c in odd_docs.columns if c != "shard"] + ["shard", "slot"]
    rows = out.collect()
    check_shards(rows, 4)
    assert Counter((r.doc_id, r.text, r._row) for r in rows) == Counter((r.doc_id, r.text, r._row) for r in odd_docs.collect())
    assert sharding.shard_rows(no_docs, 4).collect() == []


def test_sharding_gathers_no_texts(spark, odd_docs):
    """A bucket is gathered as row numbers; the rows are joined to their places without a broadcast."""
    execution = sharding.shard_rows(odd_docs, 4)._jdf.queryExecution()
    plan = execution.optimizedPlan().toString()
    gathered = [line for line in plan.splitlines() if "collect_list(" in line]
    assert len(gathered) == 1 and "collect_list(_id#" in gathered[0] and "_row#" not in gathered[0]
    assert "rightHint=(strategy=merge)" in plan
    # Buckets are dealt over all tasks before they are shuffled.
    assert "REPARTITION_BY_NUM" in execution.executedPlan().toString()


def test_sharding_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = QUERIES["op9_sharding"](spark, SMALL).collect()
    check_shards(rows, 16)
    assert {r.doc_id: (r.size, r.text_crc32) for r in rows} == {d: (len(t.encode()) + 1, zlib.crc32(t.encode())) for d, t in texts.items()}
    assert sorted(tuple(r) for r in rows) == sorted(tuple(r) for r in QUERIES["op9_sharding"](spark, SMALL).collect())
    order = [r.doc_id for r in sorted(rows, key=lambda r: (r.slot, r.shard))]
    assert sum(b == a + 1 for a, b in zip(order, order[1:], strict=False)) < 10


def shared_targets(sizes):
    """Weights 1, 2, 3 repeating by code point, NULL last; excess over three times the size is reshared."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    target, free, rest = {}, set(names), float(sum(sizes.values()))
    while free:
        level = rest / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > 3 * sizes[s]}
        if not over:
            target |= {s: level * weight[s] for s in free}
            break
        target |= {s: 3.0 * sizes[s] for s in over}
        rest -= sum(3.0 * sizes[s] for s in over)
        free -= over
    return target


def test_mixing_query(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    rows = QUERIES["op2_mixing"](spark, SMALL).collect()
    assert sorted(tuple(r) for r in rows) == sorted(tuple(r) for r in QUERIES["op2_mixing"](spark, SMALL).collect())
    sizes = Counter()
    for d in docs:
        sizes[d.source] += len(WORD.findall(d.text or ""))
    target, source, taken = shared_targets(sizes), {d.doc_id: d.source for d in docs}, Counter()
    assert len(rows) == len(docs)
    for r in rows:
        assert r.source_size == sizes[source[r.doc_id]] and r.target == pytest.approx(target[source[r.doc_id]])
        assert 0 <= r.taken <= 3 * r.size
        taken[source[r.doc_id]] += r.taken
    for s, wanted in target.items():
        assert abs(taken[s] - wanted) <= 2 * mixing.BLOCK


def test_mixing_shards_are_random(spark):
    numbers = [10240, 20480, 30720]
    rows = [(i, n, n, sum(numbers[:i]), sum(numbers)) for i, n in enumerate(numbers)]
    sources = spark.createDataFrame(rows, "ordinal long, blocks long, slots long, first_slot long, all_slots long")
    for seed in range(3):
        placed = mixing.draw_slots(sources, 8, seed).collect()
        assert sorted(r.out_shard * mixing.SHARD_SLOTS + r.out_slot for r in placed) == list(range(sum(numbers)))
        assert Counter(r.ordinal for r in placed) == dict(enumerate(numbers))
        counts = Counter((r.out_shard, r.ordinal) for r in placed)
        for i, n in enumerate(numbers):
            share = n / sum(numbers)
            spread = np.std([counts[shard, i] for shard in range(60)])
            # A multinomial draw of 1024 slots; 60 shards show its spread to about a tenth.
            assert spread == pytest.approx((mixing.SHARD_SLOTS * share * (1 - share)) ** 0.5, rel=0.35)


def test_mixing_draws_differ_by_seed_and_meet_the_totals(spark):
    """Many small sources, one of half of all: each has its slots, every block is used evenly, and seeds give other shards."""
    numbers = [3000] + [1 + i % 7 for i in range(800)]
    firsts = np.cumsum([0, *numbers])
    rows = [(i, max(1, n // 2), n, int(firsts[i]), sum(numbers)) for i, n in enumerate(numbers)]
    sources = spark.createDataFrame(rows, "ordinal long, blocks long, slots long, first_slot long, all_slots long").cache()
    found = [mixing.draw_slots(sources, 8, seed).collect() for seed in (0, 1)]
    for placed in found:
        assert sorted(r.out_shard * mixing.SHARD_SLOTS + r.out_slot for r in placed) == list(range(sum(numbers)))
        assert Counter(r.ordinal for r in placed) == dict(enumerate(numbers))
        uses = Counter((r.ordinal, r.block) for r in placed)
        assert all(0 <= b < rows[o][1] and n in (numbers[o] // rows[o][1], numbers[o] // rows[o][1] + 1) for (o, b), n in uses.items())
    counts = [Counter((r.out_shard, r.ordinal) for r in placed) for placed in found]
    assert counts[0] != counts[1]


def test_permutations_look_random(spark):
    """Neighbouring indices land apart, and other seeds give other permutations."""
    n = 5000
    places = [[r.p for r in spark.range(n).select("id", permuted(F.col("id"), F.lit(n), F.lit(seed)).alias("p")).orderBy("id").collect()] for seed in (1, 2)]
    assert places[0] != places[1] and all(sorted(p) == list(range(n)) for p in places)
    steps = np.diff(places[0])
    assert len(set(steps.tolist())) > 0.7 * n * 0.6 and abs(np.corrcoef(range(n), places[0])[0, 1]) < 0.06


def test_mixing_slots(spark, odd_docs, no_docs):
    mix = mixing.Mix(odd_docs)
    rows = mix.taken().collect()
    assert len(rows) == odd_docs.count() and all(r.taken <= 3 * r.size for r in rows)
    sizes = Counter()
    for d in odd_docs.collect():
        sizes[d.source] += len(WORD.findall(d.text or ""))
    target = shared_targets(sizes)
    assert {r.source: r.target for r in rows} == pytest.approx(target)
    # The manifest, slot by slot, is where the taken words come from.
    taken = Counter()
    for r in mix.manifest().collect():
        assert 0 <= r.first_word and r.first_word + r.piece <= r.size
        taken[r.doc_id, r.source] += r.piece
    assert taken == Counter({k: v for k, v in sum((Counter({(r.doc_id, r.source): r.taken}) for r in rows), Counter()).items() if v})
    uses = Counter((r.ordinal, r.block) for r in mix.slots.collect())
    assert max(uses.values()) <= 3
    assert mix.shard_counts().agg(F.sum("slots")).first()[0] == sum(uses.values())
    assert mixing.Mix(no_docs).taken().collect() == [] and mixing.mixed_documents(no_docs).collect() == []
    repeated = Counter(r.text for r in mixing.mixed_documents(odd_docs).select("text").collect())
    assert mixing.mixed_documents(odd_docs).columns == odd_docs.columns
    by_text = Counter(r.text for r in odd_docs.collect())
    assert None not in repeated and "" not in repeated and all(n <= 3 * by_text[t] for t, n in repeated.items())


def test_mixing_plans_stay_small(spark, odd_docs, monkeypatch):
    """Slots are numbered by one join, and no plan of the mix has the joins of all its steps at once."""
    plans = []

    def kept(df):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return df

    monkeypatch.setattr(mixing, "stage", lambda df, label: stage(kept(df), label))
    kept(mixing.mixed_documents(odd_docs)).collect()
    joins = [re.findall(r"Join .*", plan) for plan in plans]
    assert max(len(found) for found in joins) <= 10
    numbered = [j for found in joins for j in found if len(re.findall(r"_chunk#", j)) == 2 and "rightHint=(strategy=merge)" in j]
    assert len(numbered) == 1


def test_chat_windows(spark):
    marks = "a<s>b\\</s>c\\\\<s>\n</s>\\"
    rows = [(1, 0, "system", "be <s> kind", "x")]
    rows += [(1, t, "user" if t % 2 else "assistant", f"{marks} {t} " + "w " * (t * 37 % 120), "x") for t in range(1, 40)]
    rows += [(2, None, None, None, None), (2, 5, "assistant", None, None), (2, 5, "assistant", None, None), (None, 1, "assistant", "ownerless", "x")]
    rows += [(3, 1, "role\\\nwith <s> line", "é漢" + "long " * 5000, "x"), (3, 2, "assistant", marks, "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, window string")
    windows = chat.format_conversations(df, budget=200, history=60)
    got = {r.conv_id: r for r in chat.digest(windows).collect()}
    given = defaultdict(list)
    for c, t, role, text, _ in rows:
        given[c].append((-1 if t is None else t, role or "", text or ""))
    assert set(got) == set(given)
    for c, turns in given.items():
        turns = sorted(turns)
        loss = "".join(x for _, r, x in turns if r == "assistant")
        assert got[c].n_turns == len(turns) and got[c].loss_chars == len(loss)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in turns).encode()).hexdigest()
        assert got[c].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    first = [r for r in chat.read_back(windows).orderBy("window").collect() if r.conv_id == 1]
    assert len(first) > 5 and all(r.text.startswith("<s>system\nbe \\<s> kind\n</s>") for r in first)
    assert all(r.n_repeated > 1 for r in first[1:]) or any(r.n_repeated > 1 for r in first[1:])
    assert chat.digest(chat.format_conversations(df.limit(0))).collect() == []


def test_chat_windows_keep_the_budget(spark):
    rng = random.Random(7)
    rows = [(1, t, "user" if t % 2 else "assistant", "w " * 300) for t in range(60)]
    for conv in range(2, 40):
        long = rng.choice([20, 150, 400])
        rows += [(conv, 0, rng.choice(["system", "user"]), "s " * rng.choice([0, 30, 90, 150, 260]))]
        rows += [(conv, t, "user" if t % 2 else "assistant", "w " * rng.randrange(long)) for t in range(1, rng.randrange(2, 60))]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    given = spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", F.col("turn").cast("long"), "role", "text")
    for turns, budget, history in ((df, 200, 60), (df, 512, 128), (df, 100, 100), (given, 512, 128)):
        several = 0
        for r in chat.format_conversations(turns, budget, history).collect():
            pieces = [p[len(chat.OPEN):].split("\n", 1) for p in r.text.split(chat.CLOSE)[:-1]]
            sizes = [len(text.split()) + chat.TURN_TOKENS for _, text in pieces]
            new, repeated = sizes[r.n_repeated :], pieces[: r.n_repeated]
            assert sum(sizes) <= budget or len(new) == 1 and all(role == "system" for role, _ in repeated[:1]) and len(repeated) <= 1
            several += len(new) > 1
        assert several or budget == history
        got = {(r.conv_id, r.n_turns) for r in chat.digest(chat.format_conversations(turns, budget, history)).collect()}
        assert got == {(r.conv_id, r["count"]) for r in turns.groupBy("conv_id").count().collect()}


def test_lines(spark):
    page = "<html><nav>menu &amp; more</nav><script>x<p>y</script><p>own {i}</p><p>twice</p><div>twice</div><!-- <p>no</p> --></html>"
    rows = [(i, "https://u@Site.org:80/a?b", page.replace("{i}", str(i)), "x", 7) for i in range(10)]
    rows += [(10, "http://other.org", page, "x", 7), (11, None, None, None, None), (12, "nonsense", "", "x", 7), (13, "http://other.org/2", page, "x", 7)]
    rows += [(14, "https://site.org/z", "<p>rare</p>menu &amp; more", "x", 7)] * 2
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string, host long")
    got = {r.page_id: r for r in lines.drop_boilerplate(df).collect()}
    assert lines.drop_boilerplate(df).count() == len(rows)
    assert got[3].host == "site.org" and got[3].text == "own 3" and (got[3].n_lines, got[3].n_removed) == (4, 3)
    assert got[10].n_removed == 0 and got[11].text == "" and got[12].host == "" and got[14].text == "rare"
    assert lines.drop_boilerplate(df.limit(0)).collect() == []


@pytest.mark.parametrize("text", ["<", "<p ", "<!--", "<script>", "<style", "a<", "\\", "\\<s>", "<s>", ">", "\n", "</s"])
def test_long_texts_take_linear_time(spark, text):
    """A text of a million characters that a careless pattern would search again from each of them."""
    long = text * (1_000_000 // len(text))
    pages = spark.createDataFrame([(1, "http://a.b", long)], "page_id long, url string, html string")
    turns = spark.createDataFrame([(1, 0, "assistant", long)], "conv_id long, turn long, role string, text string")
    start = time.time()
    line = pages.select(F.array_join(lines.lines_of(F.col("html")), "\n").alias("t")).first().t
    back = chat.digest(chat.format_conversations(turns)).first()
    assert time.time() - start < 12  # seconds with start-up, where the first patterns took minutes
    assert back.loss_sha256 == hashlib.sha256(long.encode()).hexdigest()
    assert line == {"<": long, "<p ": long.strip(), "a<": long, "\\": long, "</s": long, ">": long}.get(text, line)
    if text in ("<!--", "<script>"):
        assert line == ""


def test_lines_equal_a_plain_reading(spark):
    htmls = ["a < b", "a < b <p>c</p> d < e", "<p", "x<!-- <p> --y", "<SCRIPT>a</script>b<style>c", "<p a='<b>'>z", "<scripture>t</scripture>", "1 <br/ 2 > 3 <"]
    df = spark.createDataFrame([(i, h) for i, h in enumerate(htmls)], "i long, h string")
    got = {r.i: r.l for r in df.select("i", lines.lines_of(F.col("h")).alias("l")).collect()}

    def plain(html):
        text = re.sub(lines.OTHER_TAG, "", re.sub(lines.BLOCK_TAG, "\n", re.sub(lines.INVISIBLE.replace(r"\z", r"\Z"), "", html)))
        return [x for x in (y.strip(lines.BLANKS) for y in re.split(r"[\r\n]+", text)) if x]

    assert got == {i: plain(h) for i, h in enumerate(htmls)}


def test_columns_of_any_name(spark, odd_docs):
    pages = spark.createDataFrame([(i, "http://a.b", "<p>x</p><p>y</p>", "1", "2", "3") for i in range(4)], "page_id long, url string, html string, _frequent string, _host string, keys string")
    assert lines.drop_boilerplate(pages).select("page_id", "_frequent", "_host", "keys", "n_removed").distinct().count() == 4
    docs = odd_docs.withColumnsRenamed({"shard": "_uses", "_row": "_words", "n": "_times"})
    assert mixing.mixed_documents(docs).columns == docs.columns
