"""Samples and mixtures drawn by stable hashes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmine.functions.hashing import stable_hash
from quillmine.operators.tracking import batch_number, positions, worker_of


def lowest_ranked(rows: DataFrame, id_column: str, seed: Column | int, count: Column | int, stratum: list[str] | None = None, tie: list[str] | None = None) -> DataFrame:
    """Of each stratum the `count` rows with the lowest hash, with their rank (from 1) and hash. seed and count may
    depend on the stratum. Ties, which only repeated ids make, go by the tie columns.

    Ranking starts in each partition, so a stratum's task gets at most `count` rows of each (rank filters are pushed below
    the shuffle as group limits where count is a constant)."""
    rows = rows.withColumn("hash", stable_hash(F.col(id_column), seed))
    rank = F.row_number().over(Window.partitionBy(*(stratum or [])).orderBy("hash", *(tie or [id_column])))
    return rows.withColumn("rank", rank).where(F.col("rank") <= count)


def shuffled(rows: DataFrame, id_column: str, seed: int, epoch: int, shard_rows: int = 1000, batch_rows: int = 32, workers: int = 1) -> DataFrame:
    """Rows with shard, worker, batch and place, the order of one epoch: shards (slices of shard_rows by id) are dealt to
    workers, each worker's shards are shuffled, and rows within batches of batch_rows of a shard. Orders are by SHA-256 of the
    epoch's seed and the shard's or row's name. place counts over all rows, worker by worker; no task orders more than a range."""
    numbered = positions(rows, id_column, name="_place")
    shard = batch_number(F.col("_place"), shard_rows)
    numbered = numbered.withColumn("shard", shard).withColumn("worker", worker_of(F.col("shard"), workers))
    numbered = numbered.withColumn("batch", batch_number(F.col("_place") % shard_rows, batch_rows)).drop("_place")
    keyed = numbered.withColumns({"_shard_key": stable_hash(F.col("shard"), seed + epoch), "_row_key": stable_hash(F.col(id_column), seed + epoch)})
    return positions(keyed, "worker", "_shard_key", "shard", "batch", "_row_key", id_column, name="place").drop("_shard_key", "_row_key")


def mixture_manifest(rows: DataFrame, id_column: str, kind_column: str, main_kind, other_kinds, other_fraction: float, seed: int, limit: int | None = None) -> DataFrame:
    """All documents of the main kind (or the first `limit`), and of each other kind as many of the lowest
    hash as make the wanted fraction: doc_id, kind."""
    from quillmine.functions.hashing import quota_per_kind
    from quillmine.operators.tracking import ids_as_text

    main = ids_as_text(rows, id_column, F.col(kind_column) == main_kind, limit)
    quota = quota_per_kind(main.count(), other_fraction, len(other_kinds))
    others = rows.where(F.col(kind_column).isin(*other_kinds)).select(F.col(id_column).cast("string").alias(id_column), kind_column)
    place = F.array_position(F.array(*map(F.lit, other_kinds)), F.col(kind_column))
    drawn = lowest_ranked(others, id_column, F.lit(seed) + place, quota, [kind_column])
    return main.select(id_column, F.lit(main_kind).alias(kind_column)).unionByName(drawn.select(id_column, kind_column))
