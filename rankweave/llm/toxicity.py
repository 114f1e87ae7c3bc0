"""Toxicity: a bidirectional gated recurrent network over words and their characters scores all windows of a text."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankweave.llm.gru import Scorer, train

FOLDS = 5
MAX_TOXIC, MAX_CLEAN = 1000, 2000  # labelled documents that the network is fitted on, at most
MAX_TRAINING_CHARS = 3000  # longer documents are fitted on only where there are too few others
MAX_LONG_CHARS = 60_000  # and of these as many characters, from a place that a hash gives


def fold(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS))


def fit_toxicity(
    documents: DataFrame, labels: DataFrame, *, max_toxic: int = MAX_TOXIC, max_clean: int = MAX_CLEAN, max_chars: int = MAX_TRAINING_CHARS
):
    """Fit on at most ``max_toxic`` and ``max_clean`` labelled documents outside fold 0, those of up to ``max_chars`` first.

    Labels are drawn by a hash of the id, three times as many as are used; their number is bounded, so they are
    broadcast and texts are not shuffled. All windows of a document are fitted on together, of one longer than
    ``MAX_LONG_CHARS`` those of a stretch. Null ids, labels and texts are left out.
    """
    known = labels.where(F.col("doc_id").isNotNull() & (fold(F.col("doc_id")) != 0)).select("doc_id", "toxic")
    order = [F.xxhash64(F.col("doc_id").cast("string"), F.lit("toxicity")), F.col("doc_id")]
    drawn = (
        known.where("toxic = 1").orderBy(*order).limit(3 * max_toxic).unionByName(known.where("toxic = 0").orderBy(*order).limit(3 * max_clean))
    )
    over = F.greatest(F.length("text") - MAX_LONG_CHARS, F.lit(0))
    stretch = F.substring("text", (F.pmod(F.xxhash64("text"), over + 1) + 1).cast("int"), F.lit(MAX_LONG_CHARS))
    texts = documents.where("text is not null").select("doc_id", stretch.alias("text"), (F.length("text") > max_chars).alias("long"))
    found = texts.join(F.broadcast(drawn.distinct()), "doc_id")
    rows = [
        row
        for label, most in ((1, max_toxic), (0, max_clean))
        for row in found.where(F.col("toxic") == label).orderBy("long", *order, "text").limit(most).collect()
    ]
    return train([row["text"] for row in rows], [row["toxic"] for row in rows])


def score_toxicity(documents: DataFrame, labels: DataFrame, *, model=None) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for each row of ``documents``.

    ``score`` is the largest probability over all overlapping windows of the whole text, from the text alone. A text
    without words, null or empty, has one empty window and so the network's constant. ``held_out``: the row is in fold
    0, which is never fitted on; null ids are not. Without labels of both kinds the score is what an unfitted network
    gives. Repeated rows have equal scores and stay; an empty table gives an empty result.
    """
    fitted = documents.sparkSession.sparkContext.broadcast(model or fit_toxicity(documents, labels))
    kind = dict(documents.select("doc_id").dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(fitted.value)
        for batch in batches:
            scores = scorer.scores([text or "" for text in batch.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    scored = documents.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")
    return scored.select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
