"""Learning rows of the two classifiers: a bounded sample of the labelled documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold_of, saved


def learning_rows(docs: DataFrame, labels: DataFrame, label: str, max_rows: int, held_out_fold: int = 5) -> DataFrame:
    """Saved (doc_id, text, label) of at most ``max_rows`` labelled ids outside the held-out fold.

    ``docs`` has (doc_id, text). Ids are taken in order of a hash of the id, so
    the sample doesn't depend on file order. Rows with a null id or label teach
    nothing; of several labels of an id the majority counts (1 on a tie).
    The sample's ids (at most max_rows x 20 bytes) are broadcast to the documents.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("double").alias("label")).dropna()
    known = known.groupBy("doc_id").agg((F.avg("label") >= 0.5).cast("int").alias("label"))
    known = known.filter(fold_of("doc_id", held_out_fold) != 0).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    return saved(docs.join(F.broadcast(known), "doc_id").select("doc_id", "text", "label"), "learning")
