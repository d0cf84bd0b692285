"""Queries over listings of stored objects, exports and prompts."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as S

from quillmine.functions import nested
from quillmine.functions import text as T
from quillmine.operators import batching, model, paragraphs, tracking
from quillmine.plans.corpus import table
from quillmine.plans.texts import CHUNKS_SQL, LINES_SQL, TOKEN_SQL
from quillmine.sources import files, sinks

QUERIES, ORACLE_SQL = {}, {}


def query(name: str, sql: str | None = None):
    def register(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLE_SQL[name] = sql
        return f

    return register


def _names(spark, sf_dir):
    """A listing as a store would give it: documents as {lang}/{id}.rtf, .RTF or .txt."""
    suffix = F.when(F.col("doc_id") % 5 == 0, ".RTF").when(F.col("doc_id") % 5 == 1, ".txt").otherwise(".rtf")
    return table(spark, sf_dir, "documents").select(F.concat("lang", F.lit("/"), F.col("doc_id").cast("string"), suffix).alias("name"), F.col("n_chars").alias("size"))


@query("object_listing", "SELECT lang || '/' || doc_id || CASE WHEN doc_id % 5 = 0 THEN '.RTF' ELSE '.rtf' END AS name, doc_id::VARCHAR AS doc_id FROM documents WHERE doc_id % 5 <> 1")
def object_listing(spark, sf_dir):
    return files.listed_ids(_names(spark, sf_dir))


@query("available_listing", "SELECT lang || '/' || doc_id AS doc_id FROM documents WHERE doc_id % 5 > 1")
def available_listing(spark, sf_dir):
    return files.available_ids(_names(spark, sf_dir))


@query("completed_listing", "SELECT doc_id::VARCHAR AS doc_id FROM documents WHERE doc_id % 3 = 0")
def completed_listing(spark, sf_dir):
    tail = F.when(F.col("doc_id") % 3 == 0, "/result.parquet").when(F.col("doc_id") % 3 == 1, "/deep/result.parquet").otherwise("/summary.json")
    return files.completed_ids(table(spark, sf_dir, "documents").select(F.concat(F.lit("v2/1/"), F.col("doc_id").cast("string"), tail).alias("name")), "v2/1/")


@query("shard_listing", "SELECT 'part-' || lpad(doc_id::VARCHAR, 6, '0') || '.parquet' AS name FROM documents WHERE doc_id % 4 <> 0 AND doc_id % 7 <> 0")
def shard_listing(spark, sf_dir):
    name = F.concat(F.lit("part-"), F.lpad(F.col("doc_id").cast("string"), 6, "0"), F.when(F.col("doc_id") % 4 == 0, ".tmp").otherwise(".parquet"))
    listed = table(spark, sf_dir, "documents").select(name.alias("name"), F.when(F.col("doc_id") % 7 == 0, 0).when(F.col("doc_id") % 7 == 1, None).otherwise(1).alias("size"))
    return files.shards(listed).select("name")


@query("clean_texts", "SELECT md5(text) AS text_md5 FROM documents WHERE text <> ''")
def clean_texts(spark, sf_dir):
    return files.clean_texts(spark, f"{sf_dir}/documents.parquet").select(F.md5(F.col("text").cast("binary")).alias("text_md5"))


@query("chunk_lines", f"SELECT to_json({{'doc_id': doc_id, 'chunk_id': chunk_id, 'p_from': p_from, 'p_to': p_to, 'text': text}})::VARCHAR AS value FROM ({CHUNKS_SQL.replace('1200', '4000')})")
def chunk_lines(spark, sf_dir):
    return sinks.chunk_lines(paragraphs.chunk_table(table(spark, sf_dir, "documents"), 4000))


@query("request_lines", f"""SELECT to_json({{'custom_id': custom_id, 'method': 'POST', 'url': '/v1/chat/completions', 'body': {{'model': 'a-model', 'messages': [{{'role': 'system', 'content': 'Extract.'}}, {{'role': 'user', 'content': labelled_text}}]}}}})::VARCHAR AS value FROM ({CHUNKS_SQL.replace('1200', '4000')})""")
def request_lines(spark, sf_dir):
    return sinks.request_lines(paragraphs.chunk_table(table(spark, sf_dir, "documents"), 4000), "a-model", "Extract.")


@query("token_totals", f"SELECT doc_id, sum(len(regexp_extract_all('[paragraph_id=' || i || '] ' || p, '{TOKEN_SQL}')))::BIGINT AS tokens FROM ({LINES_SQL}) GROUP BY 1")
def token_totals(spark, sf_dir):
    """With no lead-in, the batches' totals add up to the document's tokens."""
    return batching.batch_table(table(spark, sf_dir, "documents"), 500, 0).groupBy("doc_id").agg(F.sum("tokens").alias("tokens"))


CONTRACT_SQL = """{"additionalProperties": false, "properties": {"observations": {"items": {"additionalProperties": false, "properties": {"conviction_law_articles": {"items": {"type": ["string", "null"]}, "type": ["array", "null"]}, "extraction": {"additionalProperties": false, "properties": {"reasoning_part": {"additionalProperties": false, "properties": {"guilt_status": {"type": ["string", "null"]}}, "required": [], "type": "object"}}, "required": ["reasoning_part"], "type": "object"}, "paragraph_index": {"type": "integer"}, "source_quote": {"type": "string"}}, "required": ["paragraph_index", "source_quote", "extraction"], "type": "object"}, "type": "array"}}, "required": ["observations"], "type": "object"}"""


@query("prompt_preview", f"""
SELECT doc_id::VARCHAR AS document_id, count(*) AS targets, md5('Quote.' || chr(10) || chr(10) || 'Contract:' || chr(10) || '{CONTRACT_SQL}' || chr(10) || chr(10) || 'Targets:' || chr(10)
  || string_agg('[paragraph_id=' || i || '] ' || p, chr(10) ORDER BY i)) AS prompt_md5 FROM ({LINES_SQL}) GROUP BY 1""")
def prompt_preview(spark, sf_dir):
    """All map prompts without a call, under a budget that takes a document whole; each paragraph is a target."""
    rows = paragraphs.paragraph_table(table(spark, sf_dir, "documents")).withColumn("section", F.lit("descriptive"))
    kind = S.StructType([S.StructField("guilt_status", S.StringType())])
    contract = nested.struct_contract(nested.observation_schema(kind, "reasoning_part"))
    prompts = model.map_prompts(rows, 10**9, 100, {"reasoning": "Quote."}, contract)
    return prompts.select("document_id", F.size("targets").cast("long").alias("targets"), F.md5(F.col("prompt").cast("binary")).alias("prompt_md5"))


@query("extra_prompt", "SELECT DISTINCT conv_id::VARCHAR AS document_id, '{\"n\": 1}' AS payload FROM conversations WHERE role = 'user'")
def extra_prompt(spark, sf_dir):
    """H10 with a stand-in for the model."""
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("string").alias("document_id"), (F.col("turn") + 1).alias("paragraph_index"), F.when(F.col("role") == "user", "reasoning").otherwise("operative").alias("section"), "text")
    kind = S.StructType([S.StructField("n", S.IntegerType())])
    return model.side_output(rows, ("reasoning",), "Count.", kind, lambda messages: '{"n": 1}').select("document_id", "payload")


@query("missing_fields", "SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'c' ELSE '' END AS missing FROM orders")
def missing_fields(spark, sf_dir):
    """Expected fields that a record lacks."""
    own = F.when(F.col("o_orderkey") % 2 == 0, F.array(F.lit("a"), F.lit("b"))).otherwise(F.array(F.lit("c"), F.lit("b"), F.lit("a")))
    return table(spark, sf_dir, "orders").select("o_orderkey", F.array_join(tracking.missing_names(F.array(F.lit("a"), F.lit("b"), F.lit("c")), own), ",").alias("missing"))


@query("artifact_listing", """
SELECT 'v2/' || doc_id || CASE doc_id % 3 WHEN 0 THEN '/_document.json' ELSE '/notes.bin' END AS name, CASE doc_id % 3 WHEN 0 THEN 'application/json' ELSE 'application/octet-stream' END AS content_type FROM documents WHERE doc_id % 3 <> 1""")
def artifact_listing(spark, sf_dir):
    """K8: what of an artifact tree is published, and as what."""
    tail = F.when(F.col("doc_id") % 3 == 0, "/_document.json").when(F.col("doc_id") % 3 == 1, "/result.parquet").otherwise("/notes.bin")
    return sinks.artifact_listing(table(spark, sf_dir, "documents").select(F.concat(F.lit("v2/"), F.col("doc_id").cast("string"), tail).alias("name")))


@query("article_search", """
SELECT o_orderkey, o_orderstatus AS status, o_orderkey % 4 = 0 OR o_orderkey % 3 = 0 AS found FROM orders""")
def article_search(spark, sf_dir):
    """A value at a dotted path, and a search for an article at any depth."""
    key = F.col("o_orderkey")
    deep = F.struct(F.array(F.struct(F.when(key % 4 == 0, "185").otherwise("1").alias("article"))).alias("laws"), F.struct(F.col("o_orderstatus").alias("status"), F.when(key % 3 == 0, "185").alias("article")).alias("inner"))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", deep.alias("v"))
    kind = rows.schema["v"].dataType
    return rows.select("o_orderkey", nested.at_path(F.col("v"), kind, "inner.status")[0].alias("status"), nested.has_equal(F.col("v"), kind, "article", F.lit("185")).alias("found"))


@query("blank_fields", "SELECT doc_id, (doc_id % 3 = 0)::BOOLEAN AS shallow, (doc_id % 3 = 0)::BOOLEAN AND lang = 'en' AS deep FROM documents")
def blank_fields(spark, sf_dir):
    """shallow and deep content of a record."""
    inner = S.StructType([S.StructField("items", S.ArrayType(S.StructType([S.StructField("x", S.StringType())])))])
    value = F.when(F.col("doc_id") % 3 == 0, F.struct(F.array(F.struct(F.when(F.col("lang") == "en", "v").otherwise(" ").alias("x"))).alias("items")))
    rows = table(spark, sf_dir, "documents").select("doc_id", value.alias("v"))
    return rows.select("doc_id", nested.populated(F.col("v"), inner).alias("shallow"), nested.has_content(F.col("v"), inner).alias("deep"))


@query("one_line_tokens", f"SELECT doc_id, len(regexp_extract_all(text, '{TOKEN_SQL}'))::INTEGER AS tokens FROM documents")
def one_line_tokens(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.token_count(T.one_line(F.col("text"))).cast("int").alias("tokens"))
