"""Writing shards, flags, logs and exports so that a rerun does no harm."""

from __future__ import annotations

import io
import json
import re
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmine.operators.tracking import batch_number, event_shards, positions, value_counts
from quillmine.sources.shared import clear_folder, exists, put_file, stored


def sharded(rows: DataFrame, order: str, shard_rows: int) -> DataFrame:
    """K1: rows with shard, slices of shard_rows by the order column."""
    return positions(rows, order, name="_place").withColumn("shard", batch_number(F.col("_place"), shard_rows)).drop("_place")


#: Shards of which one task writes the files, each a split's, the errors' or a marker.
TASK_SHARDS = 16
#: Columns that a corpus adds to its manifest; the last one tells refused rows from clean ones.
CLEANED = ("text", "text_hash", "char_count", "split", "error")


def write_corpus(manifest: DataFrame, path: str, order: str, clean: Callable[[DataFrame], DataFrame] | None = None, shard_rows: int = 1000, compression: str = "zstd", splits: tuple[str, ...] = ("train", "validation")) -> int:
    """Manifest rows in shards of shard_rows by the order column; clean gives them split and error (it may be left out
    where they have these). Written are clean/split=S/shard=N, errors/shard=N and, once both are there, done/shard=N with the
    numbers of rows.

    A shard with a marker is neither computed nor written again; a shard without one takes the place of what an earlier run
    left of it. A shard of which a split or the errors are empty has an empty file there, written by a task. The number of
    Spark jobs does not depend on that of shards, and no list of shards comes to the driver. Returns how many were written."""
    spark = manifest.sparkSession
    rows = sharded(manifest, order, shard_rows)
    if exists(spark, f"{path}/done"):
        rows = rows.join(spark.read.schema("shard long").parquet(f"{path}/done").select("shard").distinct(), "shard", "left_anti")
    rows = stored(clean(rows) if clean else rows, "cleaned")
    of_split = [F.count_if(F.col("error").isNull() & (F.col("split") == s)).alias(s) for s in splits]
    counts = stored(rows.groupBy("shard").agg(F.count_if(F.col("error").isNotNull()).alias("errors"), *of_split), "counts")
    n = counts.count()
    if not n:
        return 0
    sound, refused = rows.where("error is null").drop("error"), rows.where("error is not null").select(order, "shard", "error")
    out = {"compression": compression, "partitionOverwriteMode": "dynamic"}
    # by number, as adaptive execution would have one task write thousands of files if they are small
    n_tasks = -(-n // TASK_SHARDS)
    sound.repartition(n_tasks, "split", "shard").write.options(**out).mode("overwrite").partitionBy("split", "shard").parquet(f"{path}/clean")
    refused.repartition(n_tasks, "shard").write.options(**out).mode("overwrite").partitionBy("shard").parquet(f"{path}/errors")
    folder = lambda *names: F.concat(*[x if isinstance(x, Column) else F.lit(x) for x in names], F.col("shard").cast("string"))
    empty = [F.when(F.col(s) == 0, F.struct(folder(f"{path}/clean/split={s}/shard=").alias("path"), F.lit(True).alias("sound"))) for s in splits]
    empty.append(F.when(F.col("errors") == 0, F.struct(folder(f"{path}/errors/shard=").alias("path"), F.lit(False).alias("sound"))))
    write_empty(counts.select(F.inline(F.array_compact(F.array(*empty)))), {True: sound.drop("split", "shard"), False: refused.drop("shard")}, compression)
    counts.repartition(n_tasks, "shard").write.mode("append").partitionBy("shard").parquet(f"{path}/done")
    return n


def write_empty(folders: DataFrame, tables: dict[bool, DataFrame], compression: str) -> int:
    """Folders (path, sound) get a file without rows, with the columns of their table; how many. Tasks write them."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schemas = {k: to_arrow_schema(t.schema) for k, t in tables.items()}

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        contents = {}
        for k, schema in schemas.items():
            out = io.BytesIO()
            pq.write_table(schema.empty_table(), out, compression=compression)
            contents[k] = out.getvalue()
        for batch in batches:
            for path, sound in zip(batch["path"], batch["sound"]):
                clear_folder(path)
                put_file(f"{path}/part-empty.parquet", contents[bool(sound)])
            yield pd.DataFrame({"n": [len(batch)]})

    return folders.mapInPandas(write, "n long").agg(F.sum("n").alias("n")).first().n or 0


def append(rows: DataFrame, table: str, replace: bool = False) -> int:
    """Rows added to (or in place of) a catalog table, in one atomic write; how many."""
    n = rows.count()
    rows.write.mode("overwrite" if replace else "append").saveAsTable(table)
    return n


def disposition(requested: str, first: bool, workers: int = 1) -> str:
    """K3: how a batch is written: the first as requested (append, truncate or empty), later ones appended; only appending
    goes with more than one worker."""
    if requested not in ("append", "truncate", "empty"):
        raise ValueError(f"no such disposition: {requested}")
    if requested != "append" and workers > 1:
        raise ValueError("more than one worker can only append")
    return requested if first else "append"


def insert_results(results: DataFrame, table: str, when: str | None = None) -> int:
    """document_id and result (JSON) with inserted_at, into a table that is made if there is none; how many."""
    if not re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*(\.[A-Za-z_][A-Za-z0-9_]*){0,2}", table):
        raise ValueError(f"not a table's name: {table!r}")
    spark = results.sparkSession
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} (document_id STRING NOT NULL, result STRING, inserted_at TIMESTAMP) USING parquet")
    at = F.current_timestamp() if when is None else F.lit(when).cast("timestamp")
    rows = results.select(F.col("document_id").cast("string").alias("document_id"), F.col("result").cast("string").alias("result"), at.alias("inserted_at"))
    rows = stored(rows, "results")
    rows.write.mode("append").saveAsTable(table)
    return rows.count()


def write_run_log(events: DataFrame, folder: str, order: str, status: str, flush_size: int) -> dict:
    """Events as events-000001.jsonl and so on, flush_size lines each in order, and summary.json with the counts of each
    status. Returns the summary."""
    shards = stored(event_shards(events, order, flush_size), "events")
    lines = shards.select("shard", order, F.to_json(F.struct(*events.columns), {"ignoreNullFields": "false"}).alias("value"))
    lines.repartition("shard").sortWithinPartitions("shard", order).select("shard", "value").write.mode("overwrite").partitionBy("shard").text(folder + "/events")
    counts = {r[status]: r.n for r in value_counts(shards, status).collect()}
    summary = {"total": sum(counts.values()), "by_status": {str(k): counts[k] for k in sorted(counts, key=str)}}
    write_marker(events.sparkSession, folder + "/summary.json", summary, replace=True)
    return summary


def create_if_absent(rows: DataFrame, path: str) -> None:
    """K4, K7: written only where nothing is yet; the writer's commit makes it appear at once."""
    rows.write.mode("ignore").parquet(path)


def chunk_lines(chunks: DataFrame) -> DataFrame:
    """One JSON line per chunk."""
    return chunks.select(F.to_json(F.struct("doc_id", "chunk_id", "p_from", "p_to", "text"), {"ignoreNullFields": "false"}).alias("value"))


def request_lines(chunks: DataFrame, model: str, instructions: str) -> DataFrame:
    """One batch request line per chunk."""
    message = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    body = F.struct(F.lit(model).alias("model"), F.array(message("system", F.lit(instructions)), message("user", F.col("labelled_text"))).alias("messages"))
    return chunks.select(F.to_json(F.struct("custom_id", F.lit("POST").alias("method"), F.lit("/v1/chat/completions").alias("url"), body.alias("body"))).alias("value"))


def write_lines(lines: DataFrame, path: str) -> None:
    lines.write.mode("overwrite").text(path)


def write_marker(spark: SparkSession, path: str, value: dict, replace: bool = False) -> bool:
    """K6: a small JSON file with sorted keys. One that is there stays unless replace is set; whether it was written."""
    if exists(spark, path) and not replace:
        return False
    text = json.dumps(value, ensure_ascii=False, sort_keys=True, indent=2)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)
    return True


#: Content types by suffix.
CONTENT_TYPES = {".json": "application/json", ".jsonl": "application/x-ndjson", ".txt": "text/plain; charset=utf-8", ".parquet": "application/vnd.apache.parquet"}


def artifact_listing(names: DataFrame, left_out: tuple[str, ...] = ("result.parquet",)) -> DataFrame:
    """K8: which files of an artifact tree are published (all but those left out), with their content types."""
    kind = F.lit("application/octet-stream")
    for suffix, says in CONTENT_TYPES.items():
        kind = F.when(F.lower("name").endswith(suffix), says).otherwise(kind)
    base = F.substring_index("name", "/", -1)
    return names.where(~base.isin(*left_out)).withColumn("content_type", kind)


def copy_tree(spark: SparkSession, source: str, target: str, left_out: tuple[str, ...] = ("result.parquet",)) -> int:
    """K8: the files of a folder written below another one, contents as they are; how many. Tasks read and write them, each file
    under another name until it is whole; contents don't pass the driver."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(source)
    root = re.sub(r"^[a-z]+:/*(?=/)", "", source.rstrip("/"))
    kept = artifact_listing(files.select(F.substring_index("path", root + "/", -1).alias("name"), "content"), left_out)
    base = target.rstrip("/")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0), batch.column(1)):
                put_file(f"{base}/{name.as_py()}", content.as_py())
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], names=["n"])

    return kept.select("name", "content").mapInArrow(write, "n long").agg(F.sum("n").alias("n")).first().n or 0


def write_files(rows: DataFrame, folder: str) -> int:
    """H7, K7: rows (name, content: text) as a file each below a folder, written by tasks; how many. A file appears whole, and
    again writes the same."""
    base = folder.rstrip("/")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0), batch.column(1)):
                put_file(f"{base}/{name.as_py()}", content.as_py().encode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], names=["n"])

    return rows.select("name", "content").mapInArrow(write, "n long").agg(F.sum("n").alias("n")).first().n or 0


def write_result_log(results: DataFrame, folder: str, when: str) -> str:
    """Results as one CSV with a header, in a folder named by the time; its path."""
    path = f"{folder.rstrip('/')}/results_{when}"
    results.coalesce(1).write.mode("overwrite").option("header", "true").csv(path)
    return path


def check_identity(spark: SparkSession, path: str, identity: str, manifest: dict | None = None) -> None:
    """K9: the identity of a run, and its manifest, written on the first run; later runs must have the same."""
    if not exists(spark, path):
        value = {"identity": identity, **({"manifest": manifest} if manifest is not None else {})}
        write_marker(spark, path, value)
    found = json.loads("\n".join(r.value for r in spark.read.text(path, wholetext=True).collect()))
    if found["identity"] != identity:
        raise ValueError(f"{path} was made with other settings")
    if manifest is not None and found.get("manifest") != json.loads(json.dumps(manifest)):
        raise ValueError(f"{path} was made from another manifest")
