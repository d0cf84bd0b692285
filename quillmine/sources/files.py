"""Reading registries, document files, shards and listings."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmine.functions.rtf import text_of_rtf
from quillmine.sources.shared import put_file

#: The columns that registries are read by; others are text.
REGISTRY = "doc_id string, justice_kind int, category_code string, doc_url string"
SECTIONS = ("introductory", "descriptive", "reasoning", "operative")


def registry(spark: SparkSession, path: str, schema: str = REGISTRY, separator: str = "\t") -> DataFrame:
    """A delimited file with a header line; a fixed schema, so that nothing is read to infer one."""
    return spark.read.csv(path, sep=separator, header=True, schema=schema, enforceSchema=False)


def documents(spark: SparkSession, path: str, pattern: str = "*.rtf") -> DataFrame:
    """Path, doc_id (file stem), content of files under a folder."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    return files.select("path", stem(F.col("path")).alias("doc_id"), "length", "content")


def rtf_documents(spark: SparkSession, path: str, code_page: str | None = "cp1251") -> DataFrame:
    """doc_id, text of RTF files."""
    return documents(spark, path).select("path", "doc_id", text_of_rtf(F.col("content"), code_page).alias("text"))


def stem(path: Column) -> Column:
    return F.regexp_replace(F.substring_index(path, "/", -1), r"\.[^.]*$", "")


def listed_ids(names: DataFrame, column: str = "name") -> DataFrame:
    """Ids of a listing's `.rtf` names, in any case of letters."""
    return names.where(F.lower(F.col(column)).endswith(".rtf")).select(column, stem(F.col(column)).alias("doc_id"))


def available_ids(names: DataFrame, column: str = "name") -> DataFrame:
    """Names that end in .rtf, without every .rtf in them; folders stay."""
    return names.where(F.col(column).endswith(".rtf")).select(F.replace(F.col(column), F.lit(".rtf"), F.lit("")).alias("doc_id"))


def completed_ids(names: DataFrame, prefix: str, column: str = "name") -> DataFrame:
    """Ids of `{prefix}{id}/result.parquet`, exactly one folder deep."""
    rest = F.substring(F.col(column), len(prefix) + 1, F.length(column))
    parts = F.split(rest, "/")
    return names.where(F.col(column).startswith(prefix) & (F.size(parts) == 2) & (F.get(parts, F.lit(1)) == "result.parquet")).select(F.get(parts, F.lit(0)).alias("doc_id"))


def shards(names: DataFrame, column: str = "name") -> DataFrame:
    """Names of shards that are not known to be empty, in order."""
    return names.where(F.col(column).endswith(".parquet") & (F.col("size").isNull() | (F.col("size") > 0))).orderBy(column)


def clean_texts(spark: SparkSession, path: str, most: int | None = None) -> DataFrame:
    """Non-empty texts of shards in the order of shard and row; only the text is read."""
    rows = spark.read.parquet(path).select("text", F.col("_metadata.file_path").alias("shard"), F.monotonically_increasing_id().alias("at")).where(F.col("text") != "")
    rows = rows.orderBy("shard", "at")
    return (rows if most is None else rows.limit(most)).select("shard", "text")


def classified_errors(rows: DataFrame) -> DataFrame:
    """document_id, paragraphs, error (null if sound) of classified paragraphs: at least one, numbered 1..n without gaps
    or repeats, sections of the four."""
    section = F.coalesce(*[F.col(c) for c in ("part", "section") if c in rows.columns])
    checked = rows.groupBy("document_id").agg(
        F.count(F.lit(1)).alias("paragraphs"), F.min("paragraph_index").alias("least"), F.max("paragraph_index").alias("most"), F.countDistinct("paragraph_index").alias("different"),
        F.count_if(~F.coalesce(section.isin(*SECTIONS), F.lit(False))).alias("odd"), F.count_if(F.col("text").isNull()).alias("empty"),
    )
    gaps = (F.col("least") != 1) | (F.col("most") != F.col("paragraphs")) | (F.col("different") != F.col("paragraphs")) | F.col("least").isNull()
    error = F.when(gaps, "paragraphs are not numbered from 1 without gaps").when(F.col("odd") > 0, "unknown section").when(F.col("empty") > 0, "paragraph without text")
    return checked.select("document_id", "paragraphs", error.alias("error"))


def object_uri(uri: Column, strict: bool = True) -> Column:
    """struct(bucket, name) of scheme://bucket/name; null if it is none, or has no name and strict asks for one."""
    bucket, name = F.regexp_extract(uri, r"^gs://([^/]+)(?:/(.*))?$", 1), F.regexp_extract(uri, r"^gs://([^/]+)(?:/(.*))?$", 2)
    return F.when((bucket != "") & ((name != "") if strict else F.lit(True)), F.struct(bucket.alias("bucket"), name.alias("name")))


def object_name(prefix: str, catalog: Column, file_name: Column) -> Column:
    """prefix/catalog/file, slashes in the catalog as underscores."""
    lead = re.sub("/+$", "", prefix.strip("/"))
    return F.concat_ws("/", F.lit(lead) if lead else F.lit(None).cast("string"), F.nullif(F.regexp_replace(catalog, r"[/\\]", "_"), F.lit("")), file_name)


def copy_blob(spark: SparkSession, source: str, target: str, replace: bool = False, chunk: int = 1 << 20) -> bool:
    """One object copied as a stream, a chunk at a time, between any stores that Spark reads; one that is there stays unless
    replace is set. Whether it was copied; a source that is not there is an error."""
    hadoop, conf = spark._jvm.org.apache.hadoop, spark._jsc.hadoopConfiguration()
    places = [hadoop.fs.Path(x) for x in (source, target)]
    stores = [p.getFileSystem(conf) for p in places]
    if not stores[0].exists(places[0]):
        raise FileNotFoundError(source)
    if stores[1].exists(places[1]) and not replace:
        return False
    hadoop.io.IOUtils.copyBytes(stores[0].open(places[0]), stores[1].create(places[1], True), chunk, True)
    return True


def download(rows: DataFrame, folder: str, opener: Callable | None = None, seconds: float = 60.0, chunk: int = 1 << 20) -> DataFrame:
    """Rows (url, name) with size and error: each URL streamed by a task into a file below a folder, a chunk at a time; a
    file appears only when it is whole. opener(url, seconds) gives something to read from (by default urllib's). A URL that
    fails has an error and no file, and the others go on; a null URL is an error. Store the result before using it twice."""
    base = folder.rstrip("/")

    def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from urllib.request import urlopen

        start = opener or (lambda url, seconds: urlopen(url, timeout=seconds))
        for batch in batches:
            out = []
            for url, name in zip(batch["url"], batch["name"]):
                try:
                    if url is None:
                        raise ValueError("no URL")
                    with start(url, seconds) as source:
                        out.append((url, name, put_file(f"{base}/{name}", iter(lambda: source.read(chunk), b"")), None))
                except (OSError, ValueError) as error:
                    out.append((url, name, None, str(error)))
            yield pd.DataFrame(out, columns=["url", "name", "size", "error"]).astype({"size": "Int64"})

    return rows.select("url", "name").mapInPandas(fetch, "url string, name string, size long, error string")
