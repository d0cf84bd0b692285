"""A pair of tables co-bucketed by crc32: one sorted Parquet file for each table and bucket, so that buckets join one by one.

Spark deals rows by murmur3 of a key, not by crc32. For each of N partitions there is an integer whose murmur3, modulo N,
is that partition; these surrogates are computed once, looked up by bucket number, and an ordinary repartition by the
surrogate then puts each bucket into the task of the same number. What a task holds is sorted by Spark, which spills, and
written as one file named by the task. Files of numbers that hold other numbers' rows are rewritten where they lie; a file that
holds just what a final file must hold stays. Nothing but lists of files, bounded by the number of buckets, comes to the driver.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmine.llm.common import give_back_memory, row_columns, row_struct, stored
from quillmine.sources.shared import ensure_checkpoint_dir, remove

BUCKETS = 600
#: Numbers beyond the buckets: keys that the other table lacks, and null keys.
ORPHANS, NULLS = BUCKETS, BUCKETS + 1
NUMBERS = BUCKETS + 2
KEY = "sale_id"


def surrogates(spark: SparkSession, numbers: int) -> list[int]:
    """For each number below `numbers` the least integer whose murmur3 hash is that number modulo `numbers`."""
    found, least = {}, 0
    while len(found) < numbers:
        some = spark.range(least, least + 16 * numbers).select("id", F.pmod(F.hash(F.col("id").cast("int")), F.lit(numbers)).alias("number"))
        for r in some.groupBy("number").agg(F.min("id").alias("id")).collect():
            found.setdefault(r.number, r.id)
        least += 16 * numbers
    return [found[k] for k in range(numbers)]


def dealt(rows: DataFrame, number: Column, keys: list[int]) -> DataFrame:
    """rows with task k holding just those of number k."""
    key = F.get(F.array(*[F.lit(k) for k in keys]), number.cast("int"))
    return rows.repartition(len(keys), key)


def own_key() -> Column:
    return F.col("row").getField(KEY)


def crc_number(salt: str, key: Column) -> Column:
    return (F.crc32(F.concat(F.lit(salt), key.cast("long").cast("string")).cast("binary")) % BUCKETS).cast("int")


@dataclass
class Table:
    """A table on its way: its rows and the folder that holds its files."""

    name: str
    rows: DataFrame
    folder: str

    @property
    def columns(self) -> list[str]:
        return self.rows.columns

    def packed(self, rows: DataFrame) -> DataFrame:
        """The columns as one, so that none can clash with a name of this module."""
        return rows.select(row_struct(self.columns))

    def order(self) -> list[Column]:
        """sale_id from the highest, then the other columns from left to right; maps have no order and are left out."""
        rest = [f.name for f in self.rows.schema if f.name != KEY and "map<" not in f.dataType.simpleString()]
        return [own_key().desc_nulls_first(), *[F.col("row").getField(c).asc_nulls_first() for c in rest]]

    def write(self, rows: DataFrame, number: Column, keys: list[int], folder: str) -> None:
        """One sorted file for each number there is, under that number."""
        dealt(rows, number, keys).sortWithinPartitions(*self.order()).select(*row_columns(self.columns)).write.option("maxRecordsPerFile", 0).parquet(folder)

    def read(self, spark: SparkSession, files: list[str]) -> DataFrame:
        """Packed rows of files, with number (of the file) and place (in the file)."""
        rows = spark.read.schema(self.rows.schema).parquet(*files) if files else self.rows.limit(0)
        hidden = rows.metadataColumn("_metadata") if files else None
        number = F.substring_index(hidden["file_path"], "/part-", -1).substr(1, 5).cast("int") if files else F.lit(None).cast("int")
        return rows.select(row_struct(self.columns), number.alias("number"), (hidden["row_index"] if files else F.lit(None).cast("long")).alias("place"))


def listed(spark: SparkSession, folder: str) -> list[tuple[int, str]]:
    """(number, path) of a folder's data files."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in store.listStatus(path)] if store.exists(path) else []
    return sorted((int(n[5:10]), f"{folder}/{n}") for n in names if n.startswith("part-"))


def drop_empty(spark: SparkSession, folder: str, numbers: set[int]) -> None:
    """Spark's writer leaves a file without rows where the first task has none; numbers: those that have rows."""
    for number, path in listed(spark, folder):
        if number not in numbers:
            remove(spark, path)
    remove(spark, f"{folder}/_SUCCESS")


def started(sales: DataFrame, lines: DataFrame, folder: str, keys: list[int]) -> tuple[Table, Table]:
    """Both tables in their starting files: sales by bucket, every fourth bucket in the file before its own; lines by item."""
    one, two = Table("sales", sales, f"{folder}/sales"), Table("sale_lines", lines, f"{folder}/sale_lines")
    bucket = F.coalesce(crc_number("s", own_key()), F.lit(NULLS))
    one.write(one.packed(sales), F.when(bucket % 4 == 1, bucket - 1).otherwise(bucket), keys, one.folder)
    two.write(two.packed(lines), F.coalesce(crc_number("", F.col("row").getField("item_id")), F.lit(0)), keys, two.folder)
    return one, two


def key_counts(rows: DataFrame) -> DataFrame:
    """sale_id, number, n of the starting files: tasks sum up their own rows first, so a hot key is a row for each task."""
    return rows.groupBy(own_key().alias(KEY), "number").agg(F.count(F.lit(1)).alias("n"))


def cells(sales: DataFrame, lines: DataFrame) -> DataFrame:
    """table_name, number (of the starting file), bucket, n, joined: at most a row for each pair of numbers. joined counts the
    pairs of rows that a line's key gives, so over a bucket it is the size of the join."""
    sales, lines = key_counts(sales), key_counts(lines)
    known = sales.where(F.col(KEY).isNotNull()).groupBy(KEY).agg(F.sum("n").alias("n_sales"))
    bucket = crc_number("s", F.col(KEY))
    in_sales = sales.select(F.lit("sales").alias("table_name"), "number", F.coalesce(bucket, F.lit(NULLS)).alias("bucket"), "n", F.lit(0).cast("long").alias("joined"))
    placed = F.when(F.col(KEY).isNull(), NULLS).when(F.col("n_sales").isNull(), ORPHANS).otherwise(bucket)
    in_lines = lines.join(known, KEY, "left").select(F.lit("sale_lines").alias("table_name"), "number", placed.alias("bucket"), "n", (F.col("n") * F.coalesce("n_sales", F.lit(0))).alias("joined"))
    return in_sales.unionByName(in_lines).groupBy("table_name", "number", "bucket").agg(F.sum("n").alias("n"), F.sum("joined").alias("joined"))


def settled(cell: DataFrame) -> DataFrame:
    """table_name, number, bucket of the starting files that hold one bucket only and all of it."""
    files = cell.groupBy("table_name", "number").agg(F.count(F.lit(1)).alias("in_file"), F.min("bucket").alias("bucket")).where("in_file = 1")
    buckets = cell.groupBy("table_name", "bucket").agg(F.count(F.lit(1)).alias("of_bucket")).where("of_bucket = 1")
    return files.join(buckets, ["table_name", "bucket"]).select("table_name", "number", "bucket")


def rewrite(spark: SparkSession, table: Table, rows: DataFrame, bucket: Column, keys: list[int], old: list[str], numbers: set[int]) -> list[tuple[int, str]]:
    """Writes rows, those of the old files, by bucket into the table's folder, and returns (bucket, path) of the new files. New
    files are whole, in a folder beside, before an old one goes; names of two writes never meet."""
    if not old:
        return []
    aside = f"{table.folder}-{uuid.uuid4().hex}"
    table.write(rows, bucket, keys, aside)
    drop_empty(spark, aside, numbers)
    for path in old:
        remove(spark, path)
    path, found = spark._jvm.org.apache.hadoop.fs.Path, []
    store = path(aside).getFileSystem(spark._jsc.hadoopConfiguration())
    for number, new in listed(spark, aside):
        found.append((number, f"{table.folder}/{new.rsplit('/', 1)[1]}"))
        if not store.rename(path(new), path(found[-1][1])):
            raise OSError(f"cannot move {new}")
    remove(spark, aside)
    return found


def id_digests(rows: DataFrame, keys: list[int]) -> DataFrame:
    """rows: bucket, place, id. bucket, n_rows, ids_sha256 of each file: ids in the order of the file, which the task of its bucket
    reads as a stream."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sha, n, number = hashlib.sha256(), 0, None
        for batch in batches:
            ids = pc.fill_null(pc.cast(batch.column(1), pa.string()), "").to_pylist()
            if ids:
                sha.update((("," if n else "") + ",".join(ids)).encode())
                n, number = n + len(ids), batch.column(0)[0].as_py()
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.array([n], pa.int64()), pa.array([sha.hexdigest()])], names=["bucket", "n_rows", "ids_sha256"])
        give_back_memory()

    return dealt(rows, F.col("bucket"), keys).sortWithinPartitions("place").select("bucket", "id").mapInArrow(digest, "bucket int, n_rows long, ids_sha256 string")


def co_bucketed(spark: SparkSession, sales: DataFrame, lines: DataFrame, folder: str) -> DataFrame:
    """Writes both tables into folder, rewrites them there by bucket, and tells of each final file table_name, path, columns,
    ids_sha256, lineage_sha256, bucket, n_rows, n_joined and rewritten.

    sales has sale_id; lines has sale_id and item_id (whole numbers). A null key has a bucket of its own, as have lines whose
    key is no sale; a null item counts as file 0. Equal rows stay apart as rows; nulls sort first; an empty table has no files.
    Other columns are carried along under whatever name. A bucket is one file, so one task writes it, as a sort that spills."""
    keys = surrogates(spark, NUMBERS)
    tables = started(sales, lines, folder, keys)
    old = {t.name: listed(spark, t.folder) for t in tables}
    cell = stored(cells(*[t.read(spark, [p for _, p in old[t.name]]) for t in tables]), "cells")
    staying = {(r.table_name, r.number): r.bucket for r in settled(cell).collect()}  # at most one for each number and table
    numbers = {(r.table_name, r.number) for r in cell.select("table_name", "number").distinct().collect()}
    buckets = {(r.table_name, r.bucket) for r in cell.select("table_name", "bucket").distinct().collect()}
    one, two = tables
    for t in tables:
        drop_empty(spark, t.folder, {k for name, k in numbers if name == t.name})
        old[t.name] = [(k, p) for k, p in old[t.name] if (t.name, k) in numbers]
    loose = {t.name: [p for k, p in old[t.name] if (t.name, k) not in staying] for t in tables}
    of_table = {t.name: {b for name, b in buckets if name == t.name} - {b for (name, _), b in staying.items() if name == t.name} for t in tables}
    known = one.read(spark, [p for _, p in old[one.name]]).select(own_key().alias("known")).where("known is not null").distinct()
    placed = two.read(spark, loose[two.name]).join(known, own_key() == F.col("known"), "left")
    bucket = F.when(own_key().isNull(), NULLS).when(F.col("known").isNull(), ORPHANS).otherwise(crc_number("s", own_key()))
    new = {two.name: rewrite(spark, two, placed.select("row", bucket.alias("bucket")), F.col("bucket"), keys, loose[two.name], of_table[two.name])}
    new[one.name] = rewrite(spark, one, one.read(spark, loose[one.name]).select("row"), F.coalesce(crc_number("s", own_key()), F.lit(NULLS)), keys, loose[one.name], of_table[one.name])
    found = []
    for t in tables:
        stay = [(k, p) for k, p in old[t.name] if (t.name, k) in staying]
        told = [(t.name, staying[t.name, k], p, False) for k, p in stay] + [(t.name, b, p, True) for b, p in new[t.name]]
        told = spark.createDataFrame(told, "table_name string, bucket int, path string, rewritten boolean").withColumn("columns", F.lit(",".join(t.columns)))
        # the bucket of a file that stayed is looked up by its number
        held = F.get(F.array(*[F.lit(staying.get((t.name, k))).cast("int") for k in range(NUMBERS)]), F.col("number"))
        ids = [t.read(spark, [p for _, p in files]).select(b.cast("int").alias("bucket"), "place", own_key().cast("long").alias("id")) for files, b in ((stay, held), (new[t.name], F.col("number")))]
        found.append(id_digests(ids[0].unionByName(ids[1]), keys).join(F.broadcast(told), "bucket"))
    lineage = cell.groupBy("table_name", "bucket").agg(F.array_sort(F.collect_list(F.struct("number", "n"))).alias("came"))
    lines_of = F.array_join(F.transform("came", lambda x: F.concat_ws(":", x["number"].cast("string"), x["n"].cast("string"))), ",")
    lineage = lineage.select("table_name", "bucket", F.sha2(lines_of.cast("binary"), 256).alias("lineage_sha256"))
    joined = cell.groupBy("bucket").agg(F.sum("joined").alias("n_joined"))
    files = found[0].unionByName(found[1])
    return files.join(lineage, ["table_name", "bucket"]).join(joined, "bucket").select("table_name", "path", "columns", "ids_sha256", "lineage_sha256", F.col("bucket").cast("long").alias("bucket"), "n_rows", "n_joined", "rewritten")


def new_folder(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/co-bucketed-{uuid.uuid4().hex}"
