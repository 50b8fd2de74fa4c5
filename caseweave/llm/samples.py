"""Bounded samples of labelled documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_STEPS = 1 << 24


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo the number of folds; NULL ids have none."""
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(folds))


def _thinned(rows: DataFrame, limit: int, seed: int) -> DataFrame:
    """About `limit` of the rows at most, picked by a hash of doc_id: reruns agree."""
    n = rows.count()
    if n <= limit:
        return rows
    place = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(seed)), F.lit(_STEPS))
    return rows.where(place < int(_STEPS * limit / n))


def _weighed(rows: DataFrame, limit: int, seed: int) -> DataFrame:
    """The thinned rows with the number of rows that each of them stands for."""
    picked = _thinned(rows, limit, seed)
    return picked.withColumn("stands_for", F.lit(rows.count() / max(picked.count(), 1)))


def labelled(
    docs: DataFrame,
    labels: DataFrame,
    column: str,
    limit: int,
    taken: Column,
    seed: int = 1,
    content: str = "text",
) -> DataFrame:
    """doc_id, text (or another content), label, stands_for of at most about `limit` documents per label.

    Only labels for which `taken` holds are read. The ids are broadcast: there are
    at most about 2 * limit of them, whatever the size of the tables. A document with
    several labels counts once, with the largest. `stands_for` is how many documents of
    its label each one stands for, so that its sums restore the shares of the labels.
    """
    known = (
        labels.where(taken & F.col(column).isin(0, 1))
        .groupBy("doc_id")
        .agg(F.max(column).cast("int").alias("label"))
    )
    ids = _weighed(known.where("label = 0"), limit, seed).unionByName(
        _weighed(known.where("label = 1"), limit, seed)
    )
    known = F.coalesce("text", F.lit("")) if content == "text" else F.col(content)
    return docs.select("doc_id", known.alias(content)).join(F.broadcast(ids), "doc_id")
