"""Fill-in-middle against a plain version, block by block and back again."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from spanloom.llm import infill
from spanloom.llm.queries import QUERIES

from .conftest import SMALL

TOKEN = re.compile(r"[A-Za-z]+|[^A-Za-z]")


def plain(doc_id, text):
    """(n, form, output, prefix_chars, middle_chars) of one document."""
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    tokens = TOKEN.findall(text)
    n = len(tokens)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", text, None, None
    prefix, middle, suffix = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    if h4 % 100 < 20:
        return n, "spm", f"<S>{suffix}<P>{prefix}<M>{middle}", len(prefix), len(middle)
    return n, "psm", f"<P>{prefix}<S>{suffix}<M>{middle}", len(prefix), len(middle)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_query_against_plain_version(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = QUERIES["op13_infill"](spark, SMALL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n, form, output, prefix, middle = plain(r.doc_id, texts[r.doc_id])
        assert (r.n, r.form, r.prefix_chars, r.middle_chars) == (n, form, prefix, middle)
        assert (r.output_sha256, r.restored_sha256) == (sha(output), sha(texts[r.doc_id]))
    assert {r.form for r in rows} == {"plain", "psm", "spm"}


ODD = [
    "", " ", "\n", "a", "é", "𝒳", "<P>", "ab<S>cd", "x<M", "<<<", "P>S>M>", "a<", "<S", "漢字 mixed with Latin\r\nlines\x00", "ß" * 300, "word " * 400,
    "a" * 5000, "<" * 3000, "é1" * 2000, "one two<three four<P", "Ｆｕｌｌ ｗｉｄｔｈ", "﻿mark", "tail>" * 50,
]


@pytest.mark.parametrize("piece,block", [(1 << 20, 1 << 18), (64, 7), (1, 1), (4000, 64)])
def test_texts_in_any_pieces_and_blocks(spark, monkeypatch, piece, block):
    monkeypatch.setattr(infill, "PIECE", piece)
    monkeypatch.setattr(infill, "BLOCK", block)
    texts = ODD if block > 1 else [t for t in ODD if len(t) < 400]
    rng = np.random.default_rng(block)
    h1, h2 = rng.integers(0, 1 << 32, len(texts)), rng.integers(0, 1 << 32, len(texts))
    free = np.array([not t or any(m in t for m in ("<P>", "<S>", "<M>")) for t in texts])
    form = np.where(free, infill.PLAIN, rng.integers(0, 3, len(texts)))
    # sliced, so that offsets do not begin at 0
    column = pa.array(["skipped", *texts, "skipped"]).slice(1, len(texts))
    out = infill.cut_texts(column, form, h1, h2)
    for i, (text, row) in enumerate(zip(texts, out.to_pylist(), strict=True)):
        tokens = TOKEN.findall(text)
        a, b = sorted((h1[i] % (len(tokens) + 1), h2[i] % (len(tokens) + 1)))
        p, m, s = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
        assert row["n"] == len(tokens)
        assert row["output"] == [text, f"<P>{p}<S>{s}<M>{m}", f"<S>{s}<P>{p}<M>{m}"][form[i]]
        assert (row["prefix_chars"], row["middle_chars"]) == ((None, None) if form[i] == 0 else (len(p), len(m)))
    back = [infill.gathered(data, bounds, form[low:high]) for low, high, data, bounds in infill.pieces(out.column("output"))]
    assert infill._strings(back).to_pylist() == texts


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.text(alphabet="ab<>PSM \né漢𝒳", max_size=30), st.integers(0, 2), st.integers(0, 99), st.integers(0, 99)), min_size=1, max_size=12))
def test_round_trip(cases):
    texts = [c[0] for c in cases]
    form = np.array([0 if any(m in t for m in ("<P>", "<S>", "<M>")) else f for t, f, _, _ in cases])
    out = infill.cut_texts(pa.array(texts), form, np.array([c[2] for c in cases]), np.array([c[3] for c in cases]))
    back = [infill.gathered(data, bounds, form[low:high]) for low, high, data, bounds in infill.pieces(out.column("output"))]
    assert infill._strings(back).to_pylist() == texts


def test_damaged_outputs_are_refused():
    with pytest.raises(ValueError, match="<M>"):
        infill.gathered(np.frombuffer(b"<P>ab<S>cd", np.uint8), np.array([0, 10]), np.array([infill.PSM]))


def test_odd_rows(spark, odd_docs, no_docs):
    out = infill.fill_in_middle(odd_docs)
    assert out.columns == [c for c in odd_docs.columns if c != "n"] + infill.OUTPUTS
    rows = infill.restore(out).collect()
    assert len(rows) == odd_docs.count() and all(r.restored == (r.text or "") for r in rows)
    assert all((r.n, r.form, r.output, r.prefix_chars, r.middle_chars) == plain(r.doc_id, r.text) for r in rows)
    assert infill.restore(infill.fill_in_middle(no_docs)).collect() == []
    clash = odd_docs.withColumnsRenamed({"shard": "_full", "_row": "_H1", "source": "restored"})
    assert infill.restore(infill.fill_in_middle(clash)).columns == ["doc_id", "text", "lang", "n_chars", "_full", "_H1", *infill.OUTPUTS, "restored"]


def test_texts_are_sent_once_and_go_back_in_portions(spark, monkeypatch):
    texts = [None if i % 7 == 0 else f"some words {i} " * 4 for i in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    sent = []

    def run_here(self, function, schema):
        batches = self.toArrow().to_batches()
        sent.append(batches)
        rows = list(function(iter(batches)))
        sent.append(rows)
        return spark.createDataFrame(pa.Table.from_batches(rows), schema)

    monkeypatch.setattr(infill, "PIECE", 300)
    with monkeypatch.context() as own:
        own.setattr(type(df), "mapInArrow", run_here)
        rows = infill.restore(infill.fill_in_middle(df)).collect()
    assert [r.restored for r in sorted(rows, key=lambda r: r.doc_id)] == [t or "" for t in texts]
    assert [r.text for r in sorted(rows, key=lambda r: r.doc_id)] == texts
    for batches, column in ((sent[0], "text"), (sent[2], "output")):
        copies = [f.name for f in batches[0].schema if batches[0].column(f.name).to_pylist() == batches[0].column(column).to_pylist()]
        strings = [f.name for f in batches[0].schema if pa.types.is_string(f.type)]
        assert copies == [column] and len(strings) <= (1 if column == "text" else 3)
    for rows in (sent[1], sent[3]):
        assert len(rows) > 5 and max(b.num_rows for b in rows) < 30


def test_very_long_text(spark):
    df = spark.createDataFrame([(1, "word é " * 1_000_000), (2, "<" * 3_000_000), (3, None)], "doc_id long, text string")
    rows = {r.doc_id: r for r in infill.restore(infill.fill_in_middle(df)).collect()}
    for i, text in ((1, "word é " * 1_000_000), (2, "<" * 3_000_000), (3, None)):
        assert (rows[i].n, rows[i].form, rows[i].output, rows[i].prefix_chars, rows[i].middle_chars) == plain(i, text)
        assert rows[i].restored == (text or "")
