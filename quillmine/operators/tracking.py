"""Tracking tables: which documents there are, which are done, which come next, and what runs have recorded."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmine.functions.rows import packed, quoted, unpacked
from quillmine.sources.shared import stored


def _text(c: Column) -> Column:
    return c.cast("string")


def existing_ids(table: DataFrame, id_column: str) -> DataFrame:
    """S3: distinct non-null ids as text."""
    return table.select(_text(F.col(id_column)).alias(id_column)).where(F.col(id_column).isNotNull()).distinct()


def table_or_empty(spark, name: str, id_column: str) -> DataFrame:
    """S3: ids of a catalog table; none if there is no such table."""
    import re

    if not re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", id_column):
        raise ValueError(f"not an identifier: {id_column!r}")
    if not spark.catalog.tableExists(name):
        return spark.createDataFrame([], f"{id_column} string")
    return existing_ids(spark.table(name), id_column)


def kind_count(table: DataFrame, id_column: str, of_kind: Column, limit: int | None = None) -> DataFrame:
    """N: distinct ids of one kind, at most limit."""
    n = F.countDistinct(F.when(of_kind, F.col(id_column)))
    return table.agg((n if limit is None else F.least(n, F.lit(limit))).alias("n"))


def ids_as_text(table: DataFrame, id_column: str, wanted: Column, limit: int | None = None) -> DataFrame:
    """Distinct ids as text where wanted (null: not), in the order of the text."""
    ids = table.where(wanted & F.col(id_column).isNotNull()).select(_text(F.col(id_column)).alias(id_column)).distinct().orderBy(id_column)
    return ids if limit is None else ids.limit(limit)


def ids_as_numbers(table: DataFrame, id_column: str, kind_column: str, kinds, wanted: Column, limit: int | None = None) -> DataFrame:
    """Distinct (id, kind) of the kinds where wanted, in the order of kind and number."""
    ids = table.where(F.col(kind_column).isin(*kinds) & wanted).select(F.expr(f"try_cast(`{id_column}` AS BIGINT)").alias(id_column), kind_column)
    ids = ids.where(F.col(id_column).isNotNull()).distinct().orderBy(kind_column, id_column)
    return ids if limit is None else ids.limit(limit)


def missing_in(left: DataFrame, right: DataFrame, id_column: str, right_column: str | None = None) -> DataFrame:
    """Rows of left whose id, as text, is not in right. Null ids go, repeated rows stay."""
    ids = existing_ids(right, right_column or id_column).select(F.col(right_column or id_column).alias("_id"))
    return left.where(F.col(id_column).isNotNull()).join(ids, _text(F.col(id_column)) == F.col("_id"), "left_anti")


def available_in(left: DataFrame, right: DataFrame, id_column: str, right_column: str | None = None) -> DataFrame:
    """J2, F7."""
    ids = existing_ids(right, right_column or id_column).select(F.col(right_column or id_column).alias("_id"))
    return left.join(ids, _text(F.col(id_column)) == F.col("_id"), "left_semi")


def with_availability(left: DataFrame, right: DataFrame, id_column: str) -> DataFrame:
    """left with is_available."""
    ids = existing_ids(right, id_column).select(F.col(id_column).alias("_id"))
    return left.join(ids, _text(F.col(id_column)) == F.col("_id"), "left").withColumn("is_available", F.col("_id").isNotNull()).drop("_id")


def marked(table: DataFrame, done: DataFrame, keys: list[str], flag: str) -> DataFrame:
    """The table with flag true for rows whose keys are in done; others keep theirs."""
    hits = done.select(*keys).distinct().withColumn("_done", F.lit(True))
    joined = table.join(hits, keys, "left")
    return joined.select(*[F.coalesce("_done", flag).alias(flag) if c == flag else F.col(c) for c in table.columns])


def only_new(rows: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """K4: what a create-if-absent write would create."""
    return rows.dropDuplicates(keys).join(existing.select(*keys), keys, "left_anti")


def with_row_number(rows: DataFrame, order: list, name: str, partition_by: list | None = None) -> DataFrame:
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(*(partition_by or [])).orderBy(*order)))


def in_ranges(rows: DataFrame, *order: str | Column) -> DataFrame:
    """rows in ranges of the order columns, of any type, sorted within and stored, with _part (ranges in order) and _at (place
    in the range, from 0). The order columns should tell rows apart: equal ones share a range, in no fixed order."""
    order = [F.col(quoted(c)) if isinstance(c, str) else c for c in order]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    # an id of its own is the number of the partition above 33 bits for the place in it
    numbered = ranged.withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    return stored(numbered, "ranges")


def _packed_ranges(rows: DataFrame, order: tuple[str, ...]) -> DataFrame:
    """in_ranges() of rows as one column, so that a table may have columns of any name."""
    return in_ranges(rows.select(packed(rows.columns)), *[F.col("row").getField(c) for c in order])


def _before(ranged: DataFrame, amount: Column) -> DataFrame:
    """_part and _base: what the amounts of all earlier ranges add up to. A row for each range, so one task orders them."""
    totals = ranged.groupBy("_part").agg(F.sum(amount).alias("_total"))
    return totals.select("_part", (F.sum("_total").over(Window.orderBy("_part")) - F.col("_total")).alias("_base"))


def _with(columns: list[str], name: str, value: Column) -> list[Column]:
    """The packed row's columns with one more, which takes the place of one of that name."""
    return [*unpacked([c for c in columns if c != name]), value.alias(name)]


def positions(rows: DataFrame, *order: str, name: str = "position") -> DataFrame:
    """Row numbers from 0 by order columns of any type, nulls first, the same way at every size: no task orders more than a
    range of the rows, and the sizes of ranges are added up. Columns may have any names; one called `name` is replaced."""
    ranged = _packed_ranges(rows, order)
    bases = F.broadcast(_before(ranged, F.lit(1).cast("long")))
    return ranged.join(bases, "_part").select(*_with(rows.columns, name, F.col("_base") + F.col("_at")))


def running_total(rows: DataFrame, amount: str, *order: str, name: str) -> DataFrame:
    """rows with the sum of the amounts of all rows before, in the order of the columns. Names as for positions()."""
    ranged = _packed_ranges(rows, order)
    own = F.col("row").getField(amount)
    bases = F.broadcast(_before(ranged, own))
    within = F.sum(own).over(Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)) - own
    return ranged.withColumn("_within", within).join(bases, "_part").select(*_with(rows.columns, name, F.col("_within") + F.col("_base")))


def batch_number(position: Column, size: int) -> Column:
    """Consecutive slices of `size`, the last one short."""
    if size <= 0:
        raise ValueError("the batch size must be positive")
    return F.floor(position / size)


def worker_of(position: Column, workers: int) -> Column:
    """W12."""
    return F.pmod(position, F.lit(workers))


def category_frequency(rows: DataFrame, code: str, categories: DataFrame | None = None, category_code: str | None = None) -> DataFrame:
    """Rows with a code, per code, most first; a null code has 0. With categories, their columns beside it."""
    counts = rows.groupBy(code).agg(F.count(code).alias("n"))
    if categories is not None:
        counts = counts.join(categories.withColumnRenamed(category_code, "_code"), F.col(code) == F.col("_code"), "left").drop("_code")
    return counts.orderBy(F.col("n").desc(), F.col(code))


def ranked(counts: DataFrame, *tie: str, count: str = "n", name: str = "place") -> DataFrame:
    """O3: counts with their place from 0, the most first, equal ones by the tie columns (nulls first): the order itself as a
    column, so that it outlasts a shuffle, and no task orders more than a range."""
    columns = counts.columns
    placed = positions(counts.select(packed(columns), (-F.col(quoted(count))).alias("falling"), *[F.col(quoted(c)).alias(f"tie{k}") for k, c in enumerate(tie)]), "falling", *[f"tie{k}" for k in range(len(tie))], name="place")
    return placed.select(*_with(columns, name, F.col("place")))


def run_counters(outcomes: DataFrame, status: str, statuses) -> DataFrame:
    """A3, A4, A5: how many rows have each status, in one row."""
    return outcomes.agg(F.count(F.lit(1)).alias("total"), *[F.count_if(F.col(status) == s).alias(s) for s in statuses])


def event_shards(events: DataFrame, order: str, flush_size: int) -> DataFrame:
    """Events with the name of the file they are flushed to."""
    numbered = positions(events, order, name="_place")
    return numbered.withColumn("shard", F.format_string("events-%06d.jsonl", batch_number(F.col("_place"), flush_size) + 1)).drop("_place")


def series(pairs: DataFrame, keys: list[str], step: str, before: str, value: str) -> DataFrame:
    """Keys, step, value of a series that is told in pairs (the value before, the value at a step): the first pair's earlier
    value, one step back, then each pair's later one."""
    first = pairs.groupBy(*keys).agg((F.min(step) - 1).alias(step), F.min_by(before, step).alias("value"))
    return first.unionByName(pairs.select(*keys, step, F.col(value).alias("value")))


def completed_steps(names: DataFrame, column: str = "name") -> DataFrame:
    """Steps of checkpoints that have their success marker, ascending."""
    step = F.regexp_extract(column, r"(?:^|/)checkpoint-(\d+)/_SUCCESS$", 1)
    return names.select(F.nullif(step, F.lit("")).cast("long").alias("step")).where("step is not null").distinct().orderBy("step")


def retained_steps(steps: DataFrame, keep: int, best: int | None = None) -> DataFrame:
    """Step, is_latest, kept: the last `keep` different steps and the best. Only these come to the driver."""
    last = [r.step for r in steps.select("step").distinct().orderBy(F.col("step").desc()).limit(max(keep, 1)).collect()]
    kept = [*last[:keep], *([] if best is None else [best])]
    return steps.select("step", F.col("step").eqNullSafe(F.lit(last[0] if last else None)).alias("is_latest"), F.col("step").isin(kept).alias("kept"))


def evictions(files: DataFrame, limit: int, protected: Column | None = None) -> DataFrame:
    """Files with evicted: the oldest go until the rest is within the limit; a protected file stays."""
    kept = F.lit(False) if protected is None else F.coalesce(protected, F.lit(False))
    over = (files.agg(F.sum("size")).first()[0] or 0) - limit
    rows = files.withColumn("_kept", kept).withColumn("_loose", F.when(F.col("_kept"), F.lit(0).cast("long")).otherwise(F.col("size").cast("long")))
    rows = running_total(rows, "_loose", "modified", "name", name="_gone")
    return rows.withColumn("evicted", ~F.col("_kept") & (F.col("_gone") < over)).drop("_kept", "_loose", "_gone")


def first_rows(rows: DataFrame, order: str, limit: int | None = None) -> DataFrame:
    """the first `limit` rows in the order of the column that holds the input's order; None: all."""
    if limit is not None and limit < 0:
        raise ValueError("the limit must not be negative")
    return rows if limit is None else rows.orderBy(order).limit(limit)


def is_given(rows: DataFrame, column: str) -> Column:
    """neither null, nor an empty text, nor zero, nor false. (NaN is given.)"""
    kind = rows.schema[column].dataType.simpleString()
    c = F.col(column)
    if kind in ("string", "binary"):
        some = F.length(c) > 0
    elif kind == "boolean":
        some = c
    elif kind in ("tinyint", "smallint", "int", "bigint", "float", "double") or kind.startswith("decimal"):
        some = c != 0
    else:
        some = c.isNotNull()
    return F.coalesce(some, F.lit(False))


def with_required(rows: DataFrame, *columns: str) -> DataFrame:
    """rows that have all the required fields."""
    found = F.lit(True)
    for c in columns:
        found = found & is_given(rows, c)
    return rows.where(found)


def missing_names(expected: Column, own: Column) -> Column:
    """Expected names that are not among the own ones, in the order they are expected, each once."""
    return F.array_except(expected, F.coalesce(own, F.array().cast("array<string>")))


def missing_columns(rows: DataFrame, expected: list[str]) -> list[str]:
    """Required columns that a table lacks, sorted."""
    return sorted(set(expected) - set(rows.columns))


def value_counts(rows: DataFrame, column: str, name: str = "n") -> DataFrame:
    """A3: how often each value occurs, nulls included."""
    return rows.groupBy(column).agg(F.count(F.lit(1)).alias(name))
