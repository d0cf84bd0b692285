"""Queries of corpus preparation: cleaning, gates, splits, samples, tracking."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmine.config import PreparationSettings
from quillmine.functions import hashing, mojibake
from quillmine.functions import text as T
from quillmine.operators import sampling, tracking, vocabulary
from quillmine.sources import sinks
from quillmine.sources.shared import ensure_checkpoint_dir

QUERIES, ORACLE_SQL = {}, {}
LATIN = PreparationSettings(script="Latin", least_characters=200, validation_fraction=0.10)

#: The dense normalization in SQL; what Unicode adds to white space does not occur in the tables.
DENSE_SQL = r"""trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(replace(replace(regexp_replace(nfc_normalize(text), '\r\n|\r', chr(10), 'g'), chr(160), ' '), chr(8203), ''), '[\x01-\x08\x0b\x0c\x0e-\x1f\x7f]', '', 'g'), '[ \t]+', ' ', 'g'), '(?m)^ +| +$', '', 'g'), '\n{3,}', chr(10) || chr(10), 'g'), ' ' || chr(10) || chr(9))"""
LIGHT_SQL = r"""trim(regexp_replace(regexp_replace(replace(regexp_replace(text, '\r\n|\r', chr(10), 'g'), chr(160), ' '), '(?m)[ \t]+$', '', 'g'), '\n{3,}', chr(10) || chr(10), 'g'), ' ' || chr(10) || chr(9))"""
HASH_SQL = "('0x' || substr(sha256('{seed}:' || {id}), 1, 16))::UBIGINT"


def query(name: str, sql: str | None = None):
    def register(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLE_SQL[name] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cleaned(docs: DataFrame, settings: PreparationSettings = LATIN) -> DataFrame:
    """Docs with clean, text_hash, char_count, and error instead of these three where the gate refuses."""
    settings.validate()
    rows = docs.withColumn("clean", T.normalize_dense(F.col("text")))
    ratio = T.script_ratio(F.col("clean"), settings.script)
    error = (
        F.when(F.coalesce(F.length("text"), F.lit(0)) == 0, F.lit("empty document"))
        .when(F.length("clean") < settings.least_characters, F.format_string("cleaned text has %d characters", F.length("clean")))
        .when(ratio < settings.least_script_ratio, F.format_string("script ratio is %.3f", ratio))
    )
    rows = rows.withColumn("error", error)
    sound = F.col("error").isNull()
    return rows.withColumn("text_hash", F.when(sound, T.text_hash(F.col("clean")))).withColumn("char_count", F.when(sound, F.length("clean").cast("long"))).withColumn("clean", F.when(sound, F.col("clean")))


@query("corpus_quality_split", f"""
WITH n AS (SELECT lang, doc_id, {DENSE_SQL} AS t FROM documents),
c AS (SELECT *, CASE WHEN {HASH_SQL.format(seed=42, id='doc_id')} % 10000 < 1000 THEN 'validation' ELSE 'train' END AS split,
  length(t) < 200 OR coalesce(length(regexp_replace(t, '[^\\p{{Latin}}]', '', 'g'))::DOUBLE / nullif(length(regexp_replace(t, '[^\\p{{L}}]', '', 'g')), 0), 0) < 0.2 AS refused FROM n)
SELECT lang, CASE WHEN refused THEN 'error' ELSE split END AS split, count(*) AS documents,
  coalesce(sum(CASE WHEN NOT refused THEN length(t) END), 0)::BIGINT AS characters, min(CASE WHEN NOT refused THEN sha256(t) END) AS least_hash
FROM c GROUP BY 1, 2""")
def corpus_quality_split(spark, sf_dir):
    rows = cleaned(table(spark, sf_dir, "documents"))
    split = F.when(F.col("error").isNotNull(), F.lit("error")).otherwise(hashing.split_of(F.col("doc_id"), LATIN.validation_fraction, LATIN.seed))
    return rows.groupBy("lang", split.alias("split")).agg(F.count(F.lit(1)).alias("documents"), F.coalesce(F.sum("char_count"), F.lit(0).cast("long")).alias("characters"), F.min("text_hash").alias("least_hash"))


@query("normalize_variants", f"""
SELECT doc_id, md5({LIGHT_SQL}) AS light, md5({DENSE_SQL}) AS dense, md5(trim(regexp_replace(text, '\\s+', ' ', 'g'))) AS one_line FROM documents""")
def normalize_variants(spark, sf_dir):
    text = F.col("text")
    return table(spark, sf_dir, "documents").select("doc_id", *[F.md5(c.cast("binary")).alias(n) for n, c in (("light", T.normalize_light(text)), ("dense", T.normalize_dense(text)), ("one_line", T.one_line(text)))])


@query("normalize_plain", f"SELECT doc_id, md5(nfc_normalize({LIGHT_SQL})) AS plain, length(nfc_normalize({LIGHT_SQL}))::BIGINT AS characters FROM documents")
def normalize_plain(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", T.normalize_plain(F.col("text")).alias("t"))
    return rows.select("doc_id", F.md5(F.col("t").cast("binary")).alias("plain"), F.length("t").cast("long").alias("characters"))


@query("script_ratio", """
SELECT doc_id, round(coalesce(length(regexp_replace(text, '[^\\p{Latin}]', '', 'g'))::DOUBLE / nullif(length(regexp_replace(text, '[^\\p{L}]', '', 'g')), 0), 0), 9) AS latin,
  round(coalesce(length(regexp_replace(text, '[^\\p{Cyrillic}]', '', 'g'))::DOUBLE / nullif(length(regexp_replace(text, '[^\\p{L}]', '', 'g')), 0), 0), 9) AS cyrillic FROM documents""")
def script_ratio(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.round(T.script_ratio(F.col("text"), "Latin"), 9).alias("latin"), F.round(T.script_ratio(F.col("text"), "Cyrillic"), 9).alias("cyrillic"))


@query("mojibake_fix", "SELECT doc_id, 'Вирок №' || doc_id || ' «суд» ' || lang AS repaired FROM documents")
def mojibake_fix(spark, sf_dir):
    broken = F.concat(F.lit("Âèðîê ¹"), F.col("doc_id").cast("string"), F.lit(" «ñóä» "), F.col("lang"))
    return table(spark, sf_dir, "documents").select("doc_id", T.repair_cp1251(broken).alias("repaired"))


@query("mojibake_chain", "SELECT doc_id, md5(CASE doc_id % 4 WHEN 3 THEN 'Вирок суду № ' || doc_id || ' — «' || lang || '»' ELSE text END) AS mended FROM documents")
def mojibake_chain(spark, sf_dir):
    """T2's first step: whole texts whose bytes were read wrongly not at all, once and twice over, and Cyrillic ones."""
    text = F.col("text")
    cyrillic = F.concat(F.lit("Вирок суду № "), F.col("doc_id").cast("string"), F.lit(" — «"), F.col("lang"), F.lit("»"))
    once = mojibake.misread(text, "cp1252")
    broken = F.when(F.col("doc_id") % 4 == 3, mojibake.misread(cyrillic, "cp1251")).when(F.col("doc_id") % 4 == 2, mojibake.misread(once, "cp1252")).when(F.col("doc_id") % 4 == 1, once).otherwise(text)
    rows = table(spark, sf_dir, "documents").select("doc_id", broken.alias("broken"))
    return rows.select("doc_id", F.md5(mojibake.mend(F.col("broken")).cast("binary")).alias("mended"))


@query("text_fingerprint", "SELECT 'doc' || doc_id || '_' || substr(sha1(text), 1, 12) AS name, sha256(text) AS text_hash, length(text)::BIGINT AS char_count FROM documents")
def text_fingerprint(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select(T.document_name(F.concat(F.lit("doc"), F.col("doc_id").cast("string")), F.col("text")).alias("name"), T.text_hash(F.col("text")).alias("text_hash"), F.length("text").cast("long").alias("char_count"))


@query("stable_hash_split", f"SELECT doc_id, {HASH_SQL.format(seed=7, id='doc_id')}::VARCHAR AS hash, CASE WHEN {HASH_SQL.format(seed=7, id='doc_id')} % 10000 < 250 THEN 'validation' ELSE 'train' END AS split FROM documents")
def stable_hash_split(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", hashing.stable_hash(F.col("doc_id"), 7).cast("string").alias("hash"), hashing.split_of(F.col("doc_id"), 0.025, 7).alias("split"))


@query("stratified_sample", f"""
WITH main AS (SELECT DISTINCT doc_id::VARCHAR AS doc_id FROM documents WHERE lang = 'en'),
q AS (SELECT ceil((SELECT count(*) FROM main) * 0.1::DOUBLE / (1 - 0.1::DOUBLE) / 3)::BIGINT AS quota),
others AS (SELECT doc_id::VARCHAR AS doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY {HASH_SQL.format(seed="' || (42 + CASE lang WHEN 'fr' THEN 1 WHEN 'de' THEN 2 ELSE 3 END) || '", id='doc_id')}, doc_id::VARCHAR) AS r FROM documents WHERE lang IN ('fr', 'de', 'es'))
SELECT doc_id, 'en' AS lang FROM main UNION ALL SELECT doc_id, lang FROM others, q WHERE r <= quota""")
def stratified_sample(spark, sf_dir):
    return sampling.mixture_manifest(table(spark, sf_dir, "documents"), "doc_id", "lang", "en", ["fr", "de", "es"], 0.1, 42)


@query("shuffled_epoch", f"""
WITH p AS (SELECT doc_id, lang, row_number() OVER (ORDER BY doc_id) - 1 AS p FROM documents), s AS (SELECT doc_id, lang, p // 100 AS shard, (p // 100) % 3 AS worker, (p % 100) // 32 AS batch FROM p)
SELECT doc_id, lang, shard, worker, batch, row_number() OVER (ORDER BY worker, {HASH_SQL.format(seed=43, id='shard')}, shard, batch, {HASH_SQL.format(seed=43, id='doc_id')}, doc_id) - 1 AS place FROM s""")
def shuffled_epoch(spark, sf_dir):
    return sampling.shuffled(table(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id", 42, 1, 100, 32, 3)


@query("written_corpus")
def written_corpus(spark, sf_dir):
    """K1: the cleaned corpus written in shards to a new folder, and what is read back from there."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/corpus-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    split = hashing.split_of(F.col("doc_id"), LATIN.validation_fraction, LATIN.seed)
    sinks.write_corpus(docs, folder, "doc_id", lambda rows: cleaned(rows).withColumn("split", split).select("doc_id", "shard", "split", F.col("clean").alias("text"), "text_hash", "char_count", "error"), 100)
    clean = spark.read.parquet(f"{folder}/clean").select("doc_id", F.col("shard").cast("long").alias("shard"), "split", "text_hash", F.lit(None).cast("string").alias("error"))
    refused = spark.read.parquet(f"{folder}/errors").select("doc_id", F.col("shard").cast("long").alias("shard"), F.lit("error").alias("split"), F.lit(None).cast("string").alias("text_hash"), "error")
    return clean.unionByName(refused)


@query("missing_ids", "SELECT doc_id, lang FROM documents WHERE doc_id IS NOT NULL AND doc_id::VARCHAR NOT IN (SELECT doc_id::VARCHAR FROM labels WHERE doc_id IS NOT NULL)")
def missing_ids(spark, sf_dir):
    return tracking.missing_in(table(spark, sf_dir, "documents").select("doc_id", "lang"), table(spark, sf_dir, "labels"), "doc_id")


@query("available_ids", "SELECT doc_id, lang FROM documents WHERE doc_id::VARCHAR IN (SELECT doc_id::VARCHAR FROM labels)")
def available_ids(spark, sf_dir):
    return tracking.available_in(table(spark, sf_dir, "documents").select("doc_id", "lang"), table(spark, sf_dir, "labels"), "doc_id")


@query("availability_flag", "SELECT d.doc_id, l.doc_id IS NOT NULL AS is_available FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l USING (doc_id)")
def availability_flag(spark, sf_dir):
    return tracking.with_availability(table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels"), "doc_id")


@query("existing_ids", "SELECT DISTINCT doc_id::VARCHAR AS doc_id FROM labels WHERE doc_id IS NOT NULL")
def existing_ids(spark, sf_dir):
    return tracking.existing_ids(table(spark, sf_dir, "labels"), "doc_id")


@query("kind_count", "SELECT least(count(DISTINCT CASE WHEN lang = 'en' THEN doc_id END), 500) AS n FROM documents")
def kind_count(spark, sf_dir):
    return tracking.kind_count(table(spark, sf_dir, "documents"), "doc_id", F.col("lang") == "en", 500)


@query("eligible_ids_lexicographic", "SELECT DISTINCT doc_id::VARCHAR AS doc_id FROM labels WHERE quality = 1 AND doc_id IS NOT NULL ORDER BY 1 LIMIT 100")
def eligible_ids_lexicographic(spark, sf_dir):
    return tracking.ids_as_text(table(spark, sf_dir, "labels"), "doc_id", F.col("quality") == 1, 100)


@query("eligible_ids_numeric", "SELECT DISTINCT doc_id, lang FROM documents WHERE lang IN ('de', 'fr') AND n_chars > 500 ORDER BY lang, doc_id LIMIT 100")
def eligible_ids_numeric(spark, sf_dir):
    return tracking.ids_as_numbers(table(spark, sf_dir, "documents"), "doc_id", "lang", ["de", "fr"], F.col("n_chars") > 500, 100)


@query("mark_processed", "SELECT doc_id, lang, coalesce(doc_id IN (SELECT doc_id FROM labels WHERE quality = 1), false) OR n_chars < 100 AS is_parsed FROM documents")
def mark_processed(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", (F.col("n_chars") < 100).alias("is_parsed"))
    return tracking.marked(docs, table(spark, sf_dir, "labels").where("quality = 1"), ["doc_id"], "is_parsed")


@query("only_new_rows", "SELECT DISTINCT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def only_new_rows(spark, sf_dir):
    return tracking.only_new(table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels"), ["doc_id"])


@query("shard_assignment", "SELECT doc_id, ((row_number() OVER (ORDER BY doc_id) - 1) // 100)::BIGINT AS shard FROM documents")
def shard_assignment(spark, sf_dir):
    return sinks.sharded(table(spark, sf_dir, "documents").select("doc_id"), "doc_id", 100)


@query("worker_assignment", "SELECT doc_id, ((row_number() OVER (ORDER BY doc_id) - 1) % 7)::BIGINT AS worker FROM documents")
def worker_assignment(spark, sf_dir):
    rows = tracking.positions(table(spark, sf_dir, "documents").select("doc_id"), "doc_id")
    return rows.select("doc_id", tracking.worker_of(F.col("position"), 7).alias("worker"))


@query("category_places", "SELECT c_nationkey, n, row_number() OVER (ORDER BY n DESC, c_nationkey NULLS FIRST) - 1 AS place FROM (SELECT c_nationkey, count(c_nationkey) AS n FROM (SELECT c_nationkey FROM customer UNION ALL SELECT NULL) GROUP BY 1)")
def category_places(spark, sf_dir):
    """O3: the order of the frequencies as a column."""
    rows = table(spark, sf_dir, "customer").select("c_nationkey")
    rows = rows.unionByName(spark.range(1).select(F.lit(None).cast("int").alias("c_nationkey")))
    return tracking.ranked(tracking.category_frequency(rows, "c_nationkey"), "c_nationkey")


@query("word_places", """
WITH w AS (SELECT token, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]+')) AS token FROM documents) GROUP BY 1 HAVING count(*) >= 2)
SELECT token, n, row_number() OVER (ORDER BY n DESC, token) - 1 AS place FROM w""")
def word_places(spark, sf_dir):
    """O3, O4 over all words of a corpus."""
    words = vocabulary.word_candidates(table(spark, sf_dir, "documents")).select("token", (-F.col("place")).alias("n"))
    return tracking.ranked(words, "token")


@query("category_frequency", """
SELECT n_nationkey, n_name, n_regionkey, c.n, c.c_nationkey FROM (SELECT c_nationkey, count(c_nationkey) AS n FROM (SELECT c_nationkey FROM customer UNION ALL SELECT NULL) GROUP BY 1) c
LEFT JOIN nation ON c_nationkey = n_nationkey""")
def category_frequency(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select("c_nationkey")
    rows = rows.unionByName(spark.range(1).select(F.lit(None).cast("int").alias("c_nationkey")))
    nation = table(spark, sf_dir, "nation").withColumn("key", F.col("n_nationkey"))
    return tracking.category_frequency(rows, "c_nationkey", nation, "key")


@query("run_summary", """SELECT count(*) AS total, count(*) FILTER (event_type = 'click') AS click, count(*) FILTER (event_type = 'error') AS error,
count(*) FILTER (event_type = 'purchase') AS purchase, count(*) FILTER (event_type = 'signup') AS signup FROM events""")
def run_summary(spark, sf_dir):
    return tracking.run_counters(table(spark, sf_dir, "events"), "event_type", ["click", "error", "purchase", "signup"])


@query("status_counts", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def status_counts(spark, sf_dir):
    return tracking.value_counts(table(spark, sf_dir, "events"), "event_type")


@query("head_limit", "SELECT event_id, event_type FROM events ORDER BY event_id LIMIT 77")
def head_limit(spark, sf_dir):
    """F1."""
    return tracking.first_rows(table(spark, sf_dir, "events").select("event_id", "event_type"), "event_id", 77)


@query("required_fields", "SELECT doc_id FROM documents WHERE doc_id <> 0 AND doc_id % 4 > 1")
def required_fields(spark, sf_dir):
    """rows without a URL or id go, as do empty ones and zero."""
    url = F.when(F.col("doc_id") % 4 == 0, None).when(F.col("doc_id") % 4 == 1, "").otherwise("u")
    return tracking.with_required(table(spark, sf_dir, "documents").select("doc_id", url.alias("url")), "doc_id", "url").select("doc_id")


@query("shard_assignment_of_text", "SELECT key, ((row_number() OVER (ORDER BY key) - 1) // 100)::BIGINT AS shard FROM (SELECT lang || '-' || doc_id AS key FROM documents)")
def shard_assignment_of_text(spark, sf_dir):
    """K1, W11 by ids that are text."""
    return sinks.sharded(table(spark, sf_dir, "documents").select(F.concat_ws("-", "lang", F.col("doc_id").cast("string")).alias("key")), "key", 100)


@query("event_shards", "SELECT event_id, printf('events-%06d.jsonl', ((row_number() OVER (ORDER BY event_id) - 1) // 500 + 1)::BIGINT) AS shard FROM events")
def event_shards(spark, sf_dir):
    return tracking.event_shards(table(spark, sf_dir, "events").select("event_id"), "event_id", 500)


@query("checkpoint_retention", """
WITH s AS (SELECT DISTINCT event_id * 10 AS step FROM events WHERE event_type = 'purchase'), r AS (SELECT step, row_number() OVER (ORDER BY step DESC) AS k FROM s)
SELECT step, k = 1 AS is_latest, k <= 3 OR step = (SELECT min(step) FROM s) AS kept FROM r""")
def checkpoint_retention(spark, sf_dir):
    events = table(spark, sf_dir, "events").where("event_type in ('purchase', 'error')")
    name = F.format_string("run/checkpoint-%d/%s", F.col("event_id") * 10, F.when(F.col("event_type") == "purchase", "_SUCCESS").otherwise("model.bin"))
    steps = tracking.completed_steps(events.select(name.alias("name")))
    return tracking.retained_steps(steps, 3, steps.agg(F.min("step")).first()[0])


@query("cache_eviction", """
WITH f AS (SELECT doc_id::VARCHAR AS name, n_chars AS size, doc_id % 97 AS modified FROM documents),
s AS (SELECT *, sum(size) OVER () - 200000 AS over_by, coalesce(sum(CASE WHEN name <> '5' THEN size ELSE 0 END) OVER (ORDER BY modified, name ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS gone FROM f)
SELECT name, name <> '5' AND gone < over_by AS evicted FROM s""")
def cache_eviction(spark, sf_dir):
    files = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("name"), F.col("n_chars").alias("size"), (F.col("doc_id") % 97).alias("modified"))
    return tracking.evictions(files, 200_000, F.col("name") == "5").select("name", "evicted")


@query("vocab_extension", """
WITH base AS (SELECT token, row_number() OVER (ORDER BY token) - 1 AS id FROM (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]+')) AS token FROM benchmark)),
c AS (SELECT token, -count(*) AS place FROM (SELECT unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]+')) AS token FROM documents) GROUP BY 1 HAVING count(*) >= 2),
n AS (SELECT token, row_number() OVER (ORDER BY place, token) AS r FROM c WHERE token NOT IN (SELECT token FROM base))
SELECT token, id::BIGINT AS id FROM base UNION ALL SELECT token, (r - 1 + (SELECT count(*) FROM base))::BIGINT AS id FROM n WHERE r <= 500""")
def vocab_extension(spark, sf_dir):
    base = vocabulary.number_words(vocabulary.word_candidates(table(spark, sf_dir, "benchmark"), least=1))
    return vocabulary.merged(base, vocabulary.word_candidates(table(spark, sf_dir, "documents")), 500)


@query("vocab_coverage", f"""
WITH v AS ({ORACLE_SQL['vocab_extension']}), b AS (SELECT count(DISTINCT token) AS n FROM (SELECT unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]+')) AS token FROM benchmark))
SELECT (SELECT n FROM b) AS base, (SELECT count(*) FROM v) AS final, (SELECT count(*) FROM v) - (SELECT n FROM b) AS added""")
def vocab_coverage(spark, sf_dir):
    """A12."""
    base = vocabulary.number_words(vocabulary.word_candidates(table(spark, sf_dir, "benchmark"), least=1))
    return vocabulary.coverage(base, vocabulary.merged(base, vocabulary.word_candidates(table(spark, sf_dir, "documents")), 500))
