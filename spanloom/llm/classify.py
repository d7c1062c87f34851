"""Quality classifier and language ID on subword embeddings.

Both learn on the driver from a bounded sample of labelled rows: ``PER_CLASS`` rows of each class on average,
``SAMPLE_ROWS`` of all, drawn by a hash, among texts up to ``LONGEST`` characters. Whole texts of all rows are scored on the executors,
Arrow batch by Arrow batch; the model is a table of a fixed size.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import held_out, unused, without
from .hashing import portions
from .subwords import Model, train

PER_CLASS = 600
SAMPLE_ROWS = 20_000
LONGEST = 200_000
UNDETERMINED = "und"
KEEP_AT = 0.3
LOST_SHARE = 0.001


def sample_by_class(labelled: DataFrame, label: str, per_class: int, seed: int = 0) -> DataFrame:
    """About ``per_class`` rows of each label, all of small ones, and about ``SAMPLE_ROWS`` of all at most.

    Rows are drawn by a hash of id and text, and equal rows are one.
    """
    kinds = [c for c in ("doc_id", "text") if c in labelled.columns]
    counts = labelled.groupBy(F.col(label).alias("_drawn")).agg(F.count(F.lit(1)).alias("_rows"))
    classes = counts.agg(F.greatest(F.count(F.lit(1)), F.lit(1))).first()[0]
    # A model has a vector for each label, so its labels fit a broadcast.
    rates = counts.select("_drawn", (F.lit(min(per_class, SAMPLE_ROWS / classes)) / F.col("_rows")).alias("_share"))
    draw = F.pmod(F.xxhash64(F.lit(seed), *kinds), F.lit(1 << 30)) / float(1 << 30)
    drawn = labelled.join(F.broadcast(rates), F.col(label) == F.col("_drawn")).filter(draw < F.col("_share"))
    return drawn.drop("_drawn", "_share").dropDuplicates()


def _fit(sample: DataFrame, label: str, keep_case: bool, seed: int) -> tuple[Model, np.ndarray, np.ndarray]:
    table = sample.select("doc_id", "text", label).toArrow().sort_by([("doc_id", "ascending"), ("text", "ascending")])
    return train(table.column("text"), table.column(label).to_pylist(), keep_case, seed=seed)


def fit_quality(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, seed: int = 0) -> Model | None:
    """Model of label 1 against label 0, from labelled rows outside the held-out fold; None without both labels.

    Of several labels of one document the lowest counts. Rows without text, id or label teach nothing.
    """
    known = labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
    known = known.groupBy("doc_id").agg(F.min("quality").cast("int").alias("_label"))
    drawn = sample_by_class(known, "_label", per_class, seed)
    # At most about per_class rows of two classes, whatever the size of the corpus.
    texts = docs.select("doc_id", "text").filter(F.length("text") <= LONGEST)
    sample = texts.join(F.broadcast(drawn), "doc_id")
    if len({r["_label"] for r in sample.select("_label").distinct().collect()}) < 2:
        return None
    return _fit(sample, "_label", True, seed)[0]


def score_quality(docs: DataFrame, model: Model | None) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` of label 1 (0 to 1) and ``predicted`` for every row of ``docs``.

    NULL and empty texts have no features and get the score of the bias; without a model every
    score is 0.5. Repeated rows are scored each; other columns are not read.
    """
    rows = docs.select("doc_id", held_out().alias("held_out"), "text")

    def score(batches):
        for batch in batches:
            p = model.probabilities(batch.column("text"))[:, 1] if model else np.full(batch.num_rows, 0.5)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(p, pa.float64())], ["doc_id", "held_out", "score"])

    scored = rows.mapInArrow(score, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, held_out boolean, score double")
    return scored.withColumn("predicted", F.when(F.col("score") >= KEEP_AT, 1).otherwise(0))


@dataclass
class LanguageModel:
    """A model and the calibrated score under which its answer is rejected."""

    model: Model | None
    reject_below: float


def fit_language(docs: DataFrame, per_class: int = PER_CLASS, seed: int = 0) -> LanguageModel:
    """Model of ``lang`` from rows with text and label outside the held-out fold.

    Rejection is calibrated on texts kept out of the training: the score under which at most
    ``LOST_SHARE`` of the right answers fall, and never more than 0.5.
    """
    known = docs.select("doc_id", "text", "lang").filter((F.length("text") <= LONGEST) & F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    sample = sample_by_class(known, "lang", per_class, seed)
    if sample.select("lang").distinct().limit(2).count() < 1:
        return LanguageModel(None, 0.0)
    model, p, truth = _fit(sample, "lang", False, seed)
    right = np.sort(p.max(axis=1)[p.argmax(axis=1) == truth])
    limit = float(right[int(len(right) * LOST_SHARE)]) if len(right) else 0.0
    return LanguageModel(model, min(0.5, limit))


def identify_language(docs: DataFrame, fitted: LanguageModel) -> DataFrame:
    """All columns of ``docs`` with ``lang_pred``, ``score`` (calibrated, 0 to 1) and ``rejected``; such input columns are replaced.

    NULL texts and texts without a letter are ``und`` with score 0 and rejected; so is everything if
    nothing could be learned. Other texts get the likeliest learned language, rejected if the score
    is under the calibrated limit.
    """
    model, limit = fitted.model, fitted.reject_below
    rows = without(docs, "lang_pred", "score", "rejected")
    names = rows.columns
    flag = unused(rows, "_lettered")
    lettered = rows.withColumn(flag, F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))

    def identify(batches):
        # Rows go back in portions: neither the worker nor the executor holds a second whole batch.
        for own in (x for batch in batches for x in portions(batch)):
            known = own.column(len(names)).to_numpy(zero_copy_only=False).astype(bool)
            if model is None:
                known = np.zeros(own.num_rows, bool)
                best, score = np.zeros(own.num_rows, int), np.zeros(own.num_rows)
            else:
                p = model.probabilities(own.column("text"))
                best, score = p.argmax(axis=1), p.max(axis=1)
            languages = [model.classes[b] if k else UNDETERMINED for b, k in zip(best, known)]
            score = np.where(known, score, 0.0)
            out = [own.column(i) for i in range(len(names))]
            out += [pa.array(languages, pa.string()), pa.array(score), pa.array((score < limit) | ~known)]
            yield pa.RecordBatch.from_arrays(out, [*names, "lang_pred", "score", "rejected"])

    schema = rows.schema.add("lang_pred", "string").add("score", "double").add("rejected", "boolean")
    return lettered.mapInArrow(identify, schema)
