"""Queries over paragraphs, sections, headers and nested values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as S

from quillmine.functions import grounding, nested, rtf
from quillmine.functions import text as T
from quillmine.operators import batching, html_header, model, paragraphs, sections
from quillmine.plans.corpus import LIGHT_SQL, table
from quillmine.sources import files
from quillmine.sources.shared import spread

QUERIES, ORACLE_SQL = {}, {}
LINES_SQL = f"SELECT doc_id, p, i FROM (SELECT doc_id, list_filter(list_transform(string_split(nfc_normalize({LIGHT_SQL}), chr(10)), lambda x: trim(x, ' ' || chr(9))), lambda x: x <> '') AS ps FROM documents), LATERAL (SELECT unnest(ps) AS p, generate_subscripts(ps, 1) AS i)"
BLOCKS_SQL = f"SELECT doc_id, list_filter(list_transform(regexp_split_to_array({LIGHT_SQL}, '\\n\\s*\\n+'), lambda x: trim(regexp_replace(x, '\\n+', ' ', 'g'), ' ' || chr(9))), lambda x: x <> '') AS ps FROM documents"
TOKEN_SQL = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]"
ROLE_SQL = "CASE role WHEN 'system' THEN 'introductory' WHEN 'user' THEN 'reasoning' ELSE 'operative' END"


def query(name: str, sql: str | None = None):
    def register(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLE_SQL[name] = sql
        return f

    return register


@query("paragraph_table", f"SELECT doc_id::VARCHAR AS document_id, i::INTEGER AS paragraph_index, i::INTEGER AS paragraph_order, '[paragraph_id=' || i || '] ' || p AS numbered_text, p AS text FROM ({LINES_SQL})")
def paragraph_table(spark, sf_dir):
    return paragraphs.paragraph_table(table(spark, sf_dir, "documents"))


@query("numbered_document", f"""
SELECT d.doc_id::VARCHAR AS document_id, count(i)::INTEGER AS paragraph_count, coalesce(string_agg('[paragraph_id=' || i || '] ' || p, chr(10) ORDER BY i), '') AS numbered_text, coalesce(string_agg(p, chr(10) || chr(10) ORDER BY i), '') AS text
FROM documents d LEFT JOIN ({LINES_SQL}) l ON d.doc_id = l.doc_id GROUP BY d.doc_id""")
def numbered_document(spark, sf_dir):
    return paragraphs.numbered_document(table(spark, sf_dir, "documents"))


@query("paragraph_offsets", f"""
WITH b AS ({BLOCKS_SQL}), l AS (SELECT doc_id, unnest(ps) AS text, generate_subscripts(ps, 1) AS p FROM b),
o AS (SELECT *, sum(length(text) + 2) OVER (PARTITION BY doc_id ORDER BY p) - 2 AS e FROM l)
SELECT doc_id, p::INTEGER AS p, (e - length(text))::BIGINT AS start, e::BIGINT AS "end", md5(text) AS text_md5 FROM o""")
def paragraph_offsets(spark, sf_dir):
    return paragraphs.offset_table(table(spark, sf_dir, "documents")).select("doc_id", "p", "start", "end", F.md5(F.col("text").cast("binary")).alias("text_md5"))


@query("paragraph_offsets_in_place", ORACLE_SQL["paragraph_offsets"])
def paragraph_offsets_in_place(spark, sf_dir):
    """W4 without leaving the document's row."""
    docs = table(spark, sf_dir, "documents").select("doc_id", T.blank_line_paragraphs(T.normalize_light(F.col("text"))).alias("parts"))  # a column of its own, so that it is made once
    rows = docs.select("doc_id", F.inline(paragraphs.with_offsets(F.col("parts"))))
    return rows.select("doc_id", "p", "start", "end", F.md5(F.col("text").cast("binary")).alias("text_md5"))


CHUNKS_SQL = f"""
WITH RECURSIVE b AS ({BLOCKS_SQL}), s AS (
  SELECT doc_id, ps, 1 AS p, 1 AS chunk, length(ps[1]) AS held FROM b WHERE len(ps) > 0
  UNION ALL
  SELECT doc_id, ps, p + 1, CASE WHEN held + length(ps[p + 1]) + 2 > 1200 THEN chunk + 1 ELSE chunk END, CASE WHEN held + length(ps[p + 1]) + 2 > 1200 THEN length(ps[p + 1]) + 2 ELSE held + length(ps[p + 1]) + 2 END
  FROM s WHERE p < len(ps))
SELECT doc_id, doc_id || '_c' || lpad(chunk::VARCHAR, 3, '0') AS custom_id, chunk AS chunk_id, min(p)::INTEGER AS p_from, max(p)::INTEGER AS p_to,
  string_agg(ps[p], chr(10) || chr(10) ORDER BY p) AS text, string_agg('[p' || p || '] ' || ps[p], chr(10) || chr(10) ORDER BY p) AS labelled_text
FROM s GROUP BY doc_id, chunk"""


@query("char_chunks", CHUNKS_SQL)
def char_chunks(spark, sf_dir):
    return paragraphs.chunk_table(table(spark, sf_dir, "documents"), 1200)


@query("token_batches", f"""
WITH RECURSIVE l AS ({LINES_SQL}), t AS (SELECT doc_id, i, len(regexp_extract_all('[paragraph_id=' || i || '] ' || p, '{TOKEN_SQL}')) AS n FROM l),
u AS (SELECT doc_id, list_prepend(0::HUGEINT, list(s ORDER BY i)) AS upto FROM (SELECT doc_id, i, sum(n) OVER (PARTITION BY doc_id ORDER BY i) AS s FROM t) GROUP BY doc_id),
r AS (
  SELECT doc_id, upto, 0 AS b, 0 AS lead_at, 0 AS begin_at, 0 AS end_at FROM u
  UNION ALL
  SELECT doc_id, upto, b + 1, lead_new, end_at, greatest(end_at + 1, len(list_filter(upto, lambda v: v <= upto[lead_new + 1] + 300)) - 1)
  FROM (SELECT *, CASE WHEN end_at = 0 THEN 0 ELSE greatest(0, len(list_filter(upto, lambda v: v <= upto[end_at + 1] - 40)) - 1) END AS lead_new FROM r WHERE end_at < len(upto) - 1))
SELECT doc_id, b::INTEGER AS batch_id, (lead_at + 1)::INTEGER AS context_from, (begin_at + 1)::INTEGER AS first, end_at::INTEGER AS last, (upto[end_at + 1] - upto[lead_at + 1])::BIGINT AS tokens FROM r WHERE b > 0""")
def token_batches(spark, sf_dir):
    return batching.batch_table(table(spark, sf_dir, "documents"), 300, 40)


@query("token_windows", f"""
WITH t AS (SELECT doc_id, list_transform(regexp_extract_all(text, '{TOKEN_SQL}'), lambda x: length(x)) AS ids FROM documents),
w AS (SELECT doc_id, unnest(range(0, greatest(len(ids), 1), 126)) AS pos, ids FROM t), s AS (SELECT doc_id, pos, ids[pos + 1 : pos + 126] AS part FROM w)
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY pos)::INTEGER AS n, (len(part) + 2)::INTEGER AS length, (list_sum(part) + 203)::BIGINT AS id_sum FROM s WHERE len(part) >= 32""")
def token_windows(spark, sf_dir):
    ids = F.transform(T.tokens(F.col("text")), F.length)
    docs = table(spark, sf_dir, "documents").select("doc_id", ids.alias("ids"))  # a column of its own, so that it is made once
    rows = docs.select("doc_id", F.posexplode(paragraphs.token_windows(F.col("ids"), 128, 32)).alias("at", "w"))
    return rows.select("doc_id", (F.col("at") + 1).alias("n"), F.size("w.attention_mask").alias("length"), F.aggregate("w.input_ids", F.lit(0).cast("long"), lambda a, x: a + x).alias("id_sum"))


@query("monotone_sections", f"""
WITH s AS (SELECT conv_id, turn, {ROLE_SQL} AS section FROM conversations),
m AS (SELECT *, max(CASE section WHEN 'introductory' THEN 0 WHEN 'reasoning' THEN 1 ELSE 2 END) OVER (PARTITION BY conv_id ORDER BY turn) AS stage FROM s)
SELECT conv_id, turn, section, CASE stage WHEN 0 THEN 'introductory' WHEN 1 THEN 'reasoning' ELSE 'operative' END AS effective_section FROM m""")
def monotone_sections(spark, sf_dir):
    return sections.monotone_sections(_conversation_sections(spark, sf_dir).select("conv_id", "turn", "section"), "conv_id", "turn", "section")


def _conversation_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    role = F.when(F.col("role") == "system", "introductory").when(F.col("role") == "user", "reasoning").otherwise("operative")
    return table(spark, sf_dir, "conversations").withColumn("section", role)


@query("section_islands", """
WITH s AS (SELECT conv_id, turn, role, length(text) > 300 AS chosen FROM conversations),
o AS (SELECT *, chosen AND NOT (coalesce(lag(chosen) OVER w, false) AND role IS NOT DISTINCT FROM lag(role) OVER w) AS opens FROM s WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
g AS (SELECT *, sum(opens::INTEGER) OVER (PARTITION BY conv_id ORDER BY turn) AS group_id FROM o)
SELECT conv_id, turn, role, group_id::BIGINT AS group_id FROM g WHERE chosen""")
def section_islands(spark, sf_dir):
    return sections.islands(table(spark, sf_dir, "conversations"), "conv_id", "turn", F.length("text") > 300, F.col("role")).select("conv_id", "turn", "role", "group_id")


@query("section_filter", f"SELECT conv_id, turn FROM (SELECT conv_id, turn, {ROLE_SQL} AS section FROM conversations) WHERE section IN ('descriptive', 'reasoning')")
def section_filter(spark, sf_dir):
    return _conversation_sections(spark, sf_dir).where(sections.in_section(F.col("section"), "reasoning")).select("conv_id", "turn")


@query("classified_check", "SELECT conv_id::VARCHAR AS document_id, count(*) AS paragraphs, CASE WHEN min(turn) <> 0 OR max(turn) + 1 <> count(*) OR count(DISTINCT turn) <> count(*) THEN 'paragraphs are not numbered from 1 without gaps' END AS error FROM conversations GROUP BY 1")
def classified_check(spark, sf_dir):
    rows = _conversation_sections(spark, sf_dir).select(F.col("conv_id").cast("string").alias("document_id"), (F.col("turn") + 1).alias("paragraph_index"), "section", "text")
    return files.classified_errors(rows)


@query("section_tags", """
SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN 'TITLE' WHEN 1 THEN 'FACTS_BEGIN' WHEN 2 THEN 'RULING_BEGIN' WHEN 3 THEN 'LEGAL_BASIS' WHEN 4 THEN 'FACTS_BEGIN' END AS tag, CASE WHEN doc_id % 6 = 0 THEN 'ВИРОК' END AS document_type FROM documents""")
def section_tags(spark, sf_dir):
    lines = F.array(*map(F.lit, (" Вирок ", "суд встановив:", "УХВАЛИВ:", "Керуючись ст. 1 КК", "встановила і ухвалив", "інше")))
    line = F.element_at(lines, (F.col("doc_id") % 6 + 1).cast("int"))
    return table(spark, sf_dir, "documents").select("doc_id", T.section_tag(line).alias("tag"), T.document_type(F.array(F.lit("a"), line)).alias("document_type"))


@query("metadata_extract", """
SELECT doc_id, doc_id || '/' || n_chars || '/21' AS case_number, '1-кс/' || doc_id AS proceeding_number, lpad((doc_id % 28 + 1)::VARCHAR, 2, '0') || ' ' || m || ' ' || (2000 + doc_id % 25) AS date_ua,
  (2000 + doc_id % 25) || '-' || lpad((doc_id % 12 + 1)::VARCHAR, 2, '0') || '-' || lpad((doc_id % 28 + 1)::VARCHAR, 2, '0') AS date_iso, 'Одеса' AS city, 'Районний суд ' || source AS court_line
FROM (SELECT *, (['січня', 'лютого', 'березня', 'квітня', 'травня', 'червня', 'липня', 'серпня', 'вересня', 'жовтня', 'листопада', 'грудня'])[doc_id % 12 + 1] AS m FROM documents)""")
def metadata_extract(spark, sf_dir):
    doc, month = F.col("doc_id"), F.element_at(F.array(*map(F.lit, T.MONTHS)), (F.col("doc_id") % 12 + 1).cast("int"))
    lines = F.array(
        F.concat(F.lit("Справа № "), doc.cast("string"), F.lit("/"), F.col("n_chars").cast("string"), F.lit("/21")), F.concat(F.lit("Провадження № 1-кс/"), doc.cast("string")),
        F.concat((doc % 28 + 1).cast("string"), F.lit(" "), month, F.lit(" "), (F.lit(2000) + doc % 25).cast("string"), F.lit(" року м. Одеса")), F.concat(F.lit("Районний суд "), F.col("source")),
    )
    return table(spark, sf_dir, "documents").select("doc_id", T.metadata(lines).alias("m")).select("doc_id", "m.*")


@query("header_fields", """
SELECT c_custkey, CASE WHEN c_custkey % 3 = 2 THEN NULL ELSE 'Крадіжка ' || c_mktsegment END AS case_category, CASE c_custkey % 3 WHEN 2 THEN NULL ELSE '01.02.' || (2000 + c_nationkey) END AS sent_by_court,
  CASE c_custkey % 3 WHEN 2 THEN NULL ELSE '03.04.' || (2000 + c_nationkey) END AS registered, CASE c_custkey % 3 WHEN 2 THEN NULL ELSE '05.06.' || (2000 + c_nationkey) END AS public_access_provided,
  CASE c_custkey % 3 WHEN 2 THEN NULL ELSE '1-кп/' || c_custkey END AS court_proceeding_number, CASE c_custkey % 3 WHEN 2 THEN NULL ELSE 'X&' || c_custkey END AS criminal_proceeding_number FROM customer""")
def header_fields(spark, sf_dir):
    key, year = F.col("c_custkey").cast("string"), (F.col("c_nationkey") + 2000).cast("string")
    lit = F.lit
    dates = lambda a, z: F.concat(lit(f"<tr><td>Надіслано судом: {a}01.02."), year, lit(f".{z} Зареєстровано: {a}03.04."), year, lit(f".{z} Забезпечено надання загального доступу: {a}05.06."), year, lit(f".{z}</td></tr>"))
    bold = F.concat(
        lit("<p>x</p><table id='other'><tr><td>no</td></tr></table><table id='info'><tr><td>Категорія справи № <b>"), key, lit("/1/21: Крадіжка "), F.col("c_mktsegment"), lit("</b></td></tr>"), dates("<b>", "</b>"),
        lit("<tr><td>Номер судового провадження: <b>1-кп/"), key, lit("</b></td></tr><tr><td>Номер кримінального провадження в ЄРДР:&nbsp;<b>X&amp;"), key, lit("</b></td></tr></table>"),
    )
    plain = F.concat(
        lit("<table id='info'><tr><td>Категорія справи</td><td>"), key, lit("/1/21: Крадіжка "), F.col("c_mktsegment"), lit("</td></tr>"), dates("", ""),
        lit("<tr><td>Номер судового провадження</td><td>1-кп/"), key, lit("</td></tr><tr><td>Номер кримінального провадження в ЄРДР: X&amp;"), key, lit("</td></tr></table>"),
    )
    page = F.when(F.col("c_custkey") % 3 == 0, bold).when(F.col("c_custkey") % 3 == 1, plain).otherwise(F.concat(lit("<p>no table</p>"), key))
    # a page is made of a short row and takes long to read, so the rows are dealt out before, however few files or row groups hold them
    rows = spread(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment"))
    pages = rows.select("c_custkey", page.alias("html"))
    return html_header.header_fields(pages).drop("html", "info_table_text", "info_table_rows_json")


@query("object_names", """
SELECT page_id, 'root/in/' || replace(split_part(url, '/', 4), '\\', '_') || '/' || coalesce(nullif(regexp_extract(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '[^/]*$'), ''), page_id || '.bin') AS name FROM pages""")
def object_names(spark, sf_dir):
    name = T.file_name(F.col("url"), F.col("page_id").cast("string"))
    return table(spark, sf_dir, "pages").select("page_id", files.object_name("/root/in/", F.element_at(F.split("url", "/"), 4), name).alias("name"))


@query("review_urls", """
SELECT page_id, CASE page_id % 3 WHEN 0 THEN 'https://x.example/Review/' || page_id WHEN 1 THEN 'https://reyestr.court.gov.ua/Review/' || page_id || '%20a' END AS review_url, CASE WHEN page_id % 3 = 2 THEN 'not a header page' END AS problem FROM pages""")
def review_urls(spark, sf_dir):
    page = F.col("page_id")
    url = F.when(page % 3 == 0, F.concat(F.lit("https://x.example/Review/"), page.cast("string"))).otherwise(F.col("url"))
    number = F.when(page % 3 == 1, F.concat(page.cast("string"), F.lit(" a")))
    return table(spark, sf_dir, "pages").select("page_id", html_header.review_url(url, number).alias("review_url"), html_header.review_error(url, number).alias("problem"))


@query("object_uris", "SELECT page_id, 'b' || page_id AS bucket, CASE WHEN page_id % 2 = 0 THEN 'a/' || page_id ELSE '' END AS name FROM pages")
def object_uris(spark, sf_dir):
    page = F.col("page_id")
    uri = F.concat(F.lit("gs://b"), page.cast("string"), F.when(page % 2 == 0, F.concat(F.lit("/a/"), page.cast("string"))).otherwise(""))
    return table(spark, sf_dir, "pages").select("page_id", files.object_uri(uri, strict=False).alias("u")).select("page_id", "u.bucket", "u.name")


@query("json_payload_parse", """
SELECT event_id, CASE WHEN event_id % 5 IN (0, 1, 4) THEN json_extract(props, '$.k')::BIGINT END AS k, CASE event_id % 5 WHEN 2 THEN 'broken object' WHEN 3 THEN 'not JSON or cut off' END AS error FROM events""")
def json_payload_parse(spark, sf_dir):
    """Plain, fenced, broken, followed by text, and broken in a way that the repair mends."""
    props, kind = F.col("props"), F.col("event_id") % 5
    said = (
        F.when(kind == 0, props).when(kind == 1, F.concat(F.lit("\n```JSON\n"), props, F.lit("\n```  "))).when(kind == 2, F.concat(F.lit("{x "), props))
        .when(kind == 3, F.concat(props, F.lit(" and more"))).otherwise(F.regexp_replace(props, r"\}$", ", }"))
    )
    return table(spark, sf_dir, "events").select("event_id", nested.parsed_object(said, "k long").alias("p")).select("event_id", "p.value.k", "p.error")


@query("generated_text", "SELECT event_id, props AS answer FROM events")
def generated_text(spark, sf_dir):
    quoted = F.to_json(F.struct(F.col("props").alias("generated_text")))
    messages = F.concat(F.lit("["), F.to_json(F.struct(F.array(F.struct(F.lit("user").alias("role"), F.lit("q").alias("content")), F.struct(F.lit("assistant").alias("role"), F.col("props").alias("content"))).alias("generated_text"))), F.lit("]"))
    response = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("["), quoted, F.lit("]"))).when(F.col("event_id") % 3 == 1, messages).otherwise(F.col("props"))
    return table(spark, sf_dir, "events").select("event_id", nested.generated_text(response).alias("answer"))


@query("payload_normalize", """
SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus || '; ' || o_orderpriority WHEN o_orderkey % 3 = 1 THEN NULL ELSE o_orderpriority END AS legal_references,
  CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus ELSE o_orderpriority END AS final_sentence, o_orderkey % 2 = 0 AND o_orderkey % 5 = 0 AS conflict FROM orders""")
def payload_normalize(spark, sf_dir):
    key, status, priority = F.col("o_orderkey"), F.col("o_orderstatus"), F.col("o_orderpriority")
    raw = F.when(key % 3 == 0, F.to_json(F.array(F.concat(F.lit(" "), status), F.lit(None).cast("string"), priority, F.lit("  ")))).when(key % 3 == 1, F.lit('[null, "  "]')).otherwise(priority)
    value, conflict = nested.hoisted(F.when(key % 2 == 0, status), F.when((key % 2 == 1) | (key % 5 == 0), priority))
    return table(spark, sf_dir, "orders").select("o_orderkey", nested.text_field(raw).alias("legal_references"), value.alias("final_sentence"), conflict.alias("conflict"))


@query("population_report", """
WITH l AS (SELECT l_orderkey, count(*) AS n, count(*) FILTER (l_returnflag <> 'N') AS flagged FROM lineitem GROUP BY 1),
o AS (SELECT orders.*, coalesce(n, 0) AS n, coalesce(flagged, 0) AS flagged FROM orders LEFT JOIN l ON l_orderkey = o_orderkey),
t AS (SELECT count(*) AS c, count(*) FILTER (n > 0) AS with_lines, coalesce(sum(n), 0) AS lines, coalesce(sum(flagged), 0) AS flagged, count(*) FILTER (o_orderstatus = 'F') AS f FROM o)
SELECT unnest(['key', 'note', 'lines', 'lines[].number', 'lines[].flag', 'part', 'part.priority']) AS path, unnest([c, 0, with_lines, lines, flagged, f, f])::BIGINT AS populated_values,
  unnest([c, c, c, lines, lines, c, f])::BIGINT AS observed_values, unnest([c, 0, with_lines, lines, flagged, f, f]) > 0 AS populated FROM t""")
def population_report(spark, sf_dir):
    line = F.struct(F.col("l_linenumber").alias("number"), F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).otherwise(" ").alias("flag"))
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list(line).alias("lines"))
    orders = table(spark, sf_dir, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    part = F.when(F.col("o_orderstatus") == "F", F.struct(F.col("o_orderpriority").alias("priority")))
    return nested.population_report(orders.select(F.col("o_orderkey").alias("key"), F.lit("").alias("note"), F.coalesce("lines", F.array().cast(lines.schema["lines"].dataType)).alias("lines"), part.alias("part")))


@query("deep_merge", """
WITH p AS (SELECT conv_id, turn, role, text, lead(role) OVER w AS role2, lead(text) OVER w AS text2 FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
SELECT conv_id, turn, CASE WHEN text2 IS NULL THEN md5(text) WHEN length(text2) > length(text) THEN md5(text2) ELSE md5(text) END AS text_md5,
  CASE WHEN role2 IS NULL OR role2 = role THEN role ELSE role || ',' || role2 END AS roles, text2 IS NOT NULL AND text <> text2 AS conflict FROM p""")
def deep_merge(spark, sf_dir):
    from pyspark.sql import Window

    kind = S.StructType([S.StructField("text", S.StringType()), S.StructField("roles", S.ArrayType(S.StringType()))])
    along = Window.partitionBy("conv_id").orderBy("turn")
    rows = table(spark, sf_dir, "conversations").withColumn("own", F.struct("text", F.array("role").alias("roles"))).withColumn("following", F.lead("own").over(along))
    both = rows.select("conv_id", "turn", nested.merged(F.col("own"), F.col("following"), kind).alias("m"), nested.merge_conflicts(F.col("own"), F.col("following"), kind, "p").alias("c"))
    return both.select("conv_id", "turn", F.md5(F.col("m.text").cast("binary")).alias("text_md5"), F.array_join("m.roles", ",").alias("roles"), (F.size("c") > 0).alias("conflict"))


@query("merged_conversations", """
WITH r AS (SELECT conv_id, role, min(turn) AS first FROM conversations GROUP BY 1, 2), roles AS (SELECT conv_id, string_agg(role, ',' ORDER BY first) AS roles FROM r GROUP BY 1)
SELECT c.conv_id, first(role ORDER BY length(role) DESC, turn) AS role, md5(first(text ORDER BY length(text) DESC, turn)) AS text_md5, first(length(text) ORDER BY turn)::INTEGER AS size, any_value(roles) AS roles,
  concat_ws(',', CASE WHEN count(DISTINCT length(text)) > 1 THEN '$.inner.size' END, CASE WHEN count(DISTINCT role) > 1 THEN '$.role' END, CASE WHEN count(DISTINCT text) > 1 THEN '$.text' END) AS conflicts
FROM conversations c JOIN roles USING (conv_id) GROUP BY 1""")
def merged_conversations(spark, sf_dir):
    """A9 over all partial results of a key in one ordered fold, with the paths at which they differ."""
    own = F.struct("role", "text", F.struct(F.length("text").alias("size"), F.array("role").alias("roles")).alias("inner"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", own.alias("payload"))
    found = nested.merged_all(rows, ["conv_id"], "turn", "payload")
    return found.select("conv_id", "payload.role", F.md5(F.col("payload.text").cast("binary")).alias("text_md5"), "payload.inner.size", F.array_join("payload.inner.roles", ",").alias("roles"), F.array_join("conflicts", ",").alias("conflicts"))


@query("grounding_verdict", f"""
SELECT doc_id, CASE WHEN one = '' THEN 'empty quote' WHEN doc_id % 3 < 2 THEN 'grounded' ELSE 'refused' END AS verdict
FROM (SELECT doc_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS one, regexp_extract_all(text, '{TOKEN_SQL}') AS t FROM documents)""")
def grounding_verdict(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn("t", T.tokens(F.col("text")))
    one = T.one_line(F.col("text"))
    elided = F.array_join(F.filter("t", lambda x, i: i % 3 != 1), " ")
    foreign = F.concat(one, F.lit(" ¤foreign"))
    quote = F.when(F.col("doc_id") % 3 == 0, F.substring(one, 1, 120)).when(F.col("doc_id") % 3 == 1, elided).otherwise(foreign)
    error = grounding.grounding_error(quote, F.col("text"))
    return docs.select("doc_id", F.when(error == "empty quote", error).when(error.isNull(), "grounded").otherwise("refused").alias("verdict"))


@query("observed_indexes", "SELECT o_orderkey, 1 + (o_orderkey % 3)::INTEGER AS n_indexes, (o_orderkey % 3 = 2)::INTEGER AS n_foreign FROM orders")
def observed_indexes(spark, sf_dir):
    key = F.col("o_orderkey")
    item = lambda i: F.struct(i.cast("int").alias("paragraph_index"), F.lit("q").alias("source_quote"))
    value = F.struct(F.lit(1).alias("paragraph_index"), F.transform(F.sequence(F.lit(0).cast("long"), key % 3), lambda i: item(i + 1)).alias("records"))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", value.alias("v"))
    found = nested.paragraph_indexes(F.col("v"), rows.schema["v"].dataType)
    return rows.select("o_orderkey", F.size(found).alias("n_indexes"), F.size(grounding.foreign_indexes(found, F.array(F.lit(1), F.lit(2)))).alias("n_foreign"))


@query("compact_json", """SELECT o_orderkey, '{"a":"' || o_orderstatus || '","c":[0]}' AS compact FROM orders""")
def compact_json(spark, sf_dir):
    value = F.struct(F.col("o_orderstatus").alias("a"), F.lit("  ").alias("b"), F.array(F.lit(0)).alias("c"), F.array().cast("array<string>").alias("d"), F.struct(F.lit(None).cast("string").alias("e")).alias("f"))
    return table(spark, sf_dir, "orders").select("o_orderkey", nested.compact_json(value).alias("compact"))


ARGUMENT = S.StructType([S.StructField("paragraph_index", S.IntegerType()), S.StructField("source_quote", S.StringType())])
PART = S.StructType([S.StructField("arguments", S.ArrayType(ARGUMENT)), S.StructField("article", S.StringType())])
#: What the stand-in models below do, by the paragraph's number: quotes the paragraph (3, 4), nothing to say (1), an outer quote
#: that is not in it (2), a nested one that is not (0).
VERDICT_SQL = "CASE i % 5 WHEN 0 THEN 'nested' WHEN 1 THEN 'dropped' WHEN 2 THEN 'outer' ELSE 'kept' END"


@query("map_reduce_extract", f"""
WITH l AS (SELECT doc_id, i, p, {VERDICT_SQL} AS v FROM ({LINES_SQL})),
d AS (SELECT doc_id, count(*) FILTER (v = 'kept') AS kept, count(*) FILTER (v = 'dropped') AS dropped, count(*) FILTER (v IN ('nested', 'outer')) AS ungrounded,
  string_agg(i || CASE v WHEN 'nested' THEN ': reasoning.arguments[0].source_quote' ELSE ': source_quote' END, ',' ORDER BY i) FILTER (v IN ('nested', 'outer')) AS refused,
  string_agg(i || ':' || md5(substr(p, 1, 40)), ',' ORDER BY i) FILTER (v = 'kept') AS cited FROM l GROUP BY doc_id)
SELECT doc_id::VARCHAR AS document_id, kept, dropped, ungrounded, coalesce(refused, '') AS refused,
  CASE WHEN kept > 0 THEN cited || CASE WHEN kept % 4 = 3 THEN ',999999:' || md5('x') ELSE '' END END AS cited,
  CASE WHEN kept = 0 THEN NULL WHEN kept % 4 = 3 THEN 'paragraph not observed: 999999' ELSE '' END AS errors FROM d""")
def map_reduce_extract(spark, sf_dir):
    """The extraction with stand-ins for the models, which err: answers to be mended, quotes of nothing, records without
    content, and results that cite what was not observed."""
    rows = paragraphs.paragraph_table(table(spark, sf_dir, "documents")).withColumn("section", F.lit("reasoning"))
    found = model.map_reduce(rows, PART, "reasoning", erring_model, joining_model, budget=2000, overlap=50)
    where = F.transform("problems", lambda e: F.when(F.contains(e, F.lit("arguments[0]")), F.concat(F.substring_index(e, ":", 1), F.lit(": reasoning.arguments[0].source_quote"))).otherwise(F.concat(F.substring_index(e, ":", 1), F.lit(": source_quote"))))
    cited = F.array_join(F.transform(F.from_json("result", PART)["arguments"], lambda x: F.concat_ws(":", x["paragraph_index"].cast("string"), F.md5(x["source_quote"].cast("binary")))), ",")
    return found.select("document_id", "kept", "dropped", "ungrounded", F.array_join(where, ",").alias("refused"), cited.alias("cited"), F.array_join("errors", ",").alias("errors"))


@query("document_chain", f"""
WITH c AS (SELECT conv_id, turn + 1 AS i, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS p, {ROLE_SQL} AS section FROM conversations),
v AS (SELECT *, {VERDICT_SQL} AS v FROM c),
s AS (SELECT conv_id, section, count(*) FILTER (v = 'kept') AS kept, count(*) FILTER (v IN ('nested', 'outer')) AS bad, string_agg(i::VARCHAR, ',' ORDER BY i) FILTER (v = 'kept') AS cited FROM v GROUP BY ALL),
r AS (SELECT *, kept > 0 AND kept % 4 <> 3 AS given, bad + CASE WHEN kept % 4 = 3 THEN 1 ELSE 0 END AS n FROM s)
SELECT t.*, sum(n)::BIGINT AS n_errors, sum(n) = 0 AS complete, max(CASE WHEN section = 'introductory' AND given THEN cited END) AS introductory, max(CASE WHEN section = 'reasoning' AND given THEN cited END) AS reasoning,
  max(CASE WHEN section = 'operative' AND given THEN cited END) AS operative
FROM (SELECT conv_id::VARCHAR AS document_id, md5(string_agg(p, chr(10) || chr(10) ORDER BY i)) AS text_md5 FROM c GROUP BY 1) t JOIN r ON r.conv_id::VARCHAR = t.document_id GROUP BY ALL""")
def document_chain(spark, sf_dir):
    """Three sections in turn, one row a document."""
    got = model.extraction_chain(turns(spark, sf_dir), {s: (f"{s}_part", PART) for s in ("introductory", "reasoning", "operative")}, erring_model, joining_model, budget=2000, overlap=50)
    cited = [F.array_join(F.transform(F.col(f"{s}_part.arguments"), lambda x: x["paragraph_index"].cast("string")), ",").alias(s) for s in ("introductory", "reasoning", "operative")]
    return got.select("document_id", F.md5(F.col("text").cast("binary")).alias("text_md5"), F.size("errors").cast("long").alias("n_errors"), "complete", *cited)


def turns(spark, sf_dir):
    """Conversations as documents of paragraphs in three sections."""
    section = F.when(F.col("role") == "system", "introductory").when(F.col("role") == "user", "reasoning").otherwise("operative")
    return table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("string").alias("document_id"), (F.col("turn") + 1).cast("int").alias("paragraph_index"), section.alias("section"), T.one_line(F.col("text")).alias("text"))


@query("batch_outcomes", "SELECT conv_id::VARCHAR AS document_id, CASE WHEN conv_id % 3 = 0 THEN 'error' ELSE 'success' END AS status, CASE WHEN conv_id % 3 <> 0 THEN '{\"n\": ' || conv_id || '}' END AS result FROM conversations GROUP BY conv_id")
def batch_outcomes(spark, sf_dir):
    """H13 with a stand-in that breaks down for some documents."""
    prompts = turns(spark, sf_dir).groupBy("document_id").agg(F.max("document_id").alias("prompt"))
    return model.outcomes(prompts, lambda messages: "no object" if int(messages[0]["content"].split()[0]) % 3 == 0 else f'{{"n": {messages[0]["content"]}}}', retries=0).drop("error")


@query("call_artifacts", """
WITH d AS (SELECT DISTINCT conv_id FROM conversations), c AS (SELECT conv_id, unnest(range(1, CASE WHEN conv_id % 3 = 0 THEN 3 ELSE 2 END)) AS call FROM d)
SELECT 'v2/' || conv_id || '/call-' || lpad(call::VARCHAR, 3, '0') || '.json' AS name, call::INTEGER AS call, conv_id % 3 = 0 AS refused,
  conv_id || CASE WHEN call = 2 THEN ' again' ELSE '' END AS asked, CASE WHEN conv_id % 3 = 0 THEN 'no object' ELSE '{"n": ' || conv_id || '}' END AS response FROM c""")
def call_artifacts(spark, sf_dir):
    """H7: a file for each call of a stand-in model, with what it was asked and said, also where it is asked again."""
    prompts = turns(spark, sf_dir).groupBy("document_id").agg(F.max("document_id").alias("prompt"))
    said = lambda messages: "no object" if int(messages[0]["content"].split()[0]) % 3 == 0 else f'{{"n": {messages[0]["content"].split()[0]}}}'
    files = model.call_artifacts(model.answered(prompts.withColumn("run", F.lit("v2")), said, keep_calls=True), ["run", "document_id"])
    call = files.select("name", F.from_json("content", "call int, error string, request string, response string").alias("c"))
    asked = F.regexp_replace("c.request", r"(?s)\s+The last answer.*", " again")
    return call.select("name", "c.call", F.col("c.error").isNotNull().alias("refused"), asked.alias("asked"), "c.response")


@query("rtf_round_trip", "SELECT doc_id, md5(text) AS text_md5, NULL::VARCHAR AS error FROM documents")
def rtf_round_trip(spark, sf_dir):
    """Whole texts written as RTF and read again."""
    sign = lambda c: F.when(c.isin("\\", "{", "}"), F.concat(F.lit("\\"), c)).when(c == "\n", F.lit("\\par ")).when(c == "\t", F.lit("\\tab ")).when(c >= "\x80", F.concat(F.lit("\\u"), F.ascii(c).cast("string"), F.lit("?"))).otherwise(c)
    body = F.array_join(F.transform(F.split("text", ""), sign), "")
    rows = table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("{\\rtf1\\ansi{\\fonttbl{\\f0 Some Font;}}\\f0 "), body, F.lit("}")).cast("binary").alias("content"))
    read = rows.select("doc_id", rtf.converted(F.col("content")).alias("r"))
    return read.select("doc_id", F.md5(F.col("r.text").cast("binary")).alias("text_md5"), "r.error")


@query("longest_prefix", "SELECT doc_id, least(doc_id % 300, length(one))::INTEGER AS prefix FROM (SELECT doc_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS one FROM documents)")
def longest_prefix(spark, sf_dir):
    """How far a quote that goes wrong agrees with its source."""
    one = T.one_line(F.col("text"))
    quote = F.concat(F.substring(one, F.lit(1), (F.col("doc_id") % 300).cast("int")), F.lit("¤ foreign"))
    return table(spark, sf_dir, "documents").select("doc_id", grounding.longest_prefix(quote, one).alias("prefix"))


@query("within_batch", "SELECT o_orderkey, 1 + (o_orderkey % 3 < 2)::INTEGER AS n_records FROM orders")
def within_batch(spark, sf_dir):
    """Records of paragraphs that the batch did not hold go."""
    index = lambda c: F.struct(c.cast("int").alias("paragraph_index"))
    records = F.array(index(F.col("o_orderkey") % 3), index(F.lit(None)), index(F.lit(5)))
    return table(spark, sf_dir, "orders").select("o_orderkey", F.size(grounding.within_batch(records, F.array(F.lit(0), F.lit(1)))).alias("n_records"))


@query("payload_errors", """
SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN '' WHEN 1 THEN 'payload.a must be a string' WHEN 2 THEN 'unexpected fields: [''c'']' ELSE 'payload.b[1] must be an integer' END AS errors FROM orders""")
def payload_errors(spark, sf_dir):
    """What in a payload breaks its schema."""
    key = F.col("o_orderkey") % 4
    status = F.concat(F.lit('"'), F.col("o_orderstatus"), F.lit('"'))
    body = F.when(key == 0, F.concat(F.lit('{"a": '), status, F.lit(', "b": [1, 2]}'))).when(key == 1, F.lit('{"a": 5}')).when(key == 2, F.concat(F.lit('{"a": '), status, F.lit(', "c": 1}'))).otherwise(F.concat(F.lit('{"a": '), status, F.lit(', "b": [1, "x"]}')))
    schema = S.StructType([S.StructField("a", S.StringType(), False), S.StructField("b", S.ArrayType(S.LongType(), False))])
    return table(spark, sf_dir, "orders").select("o_orderkey", F.array_join(nested.checked_payload(body, schema)["errors"], "; ").alias("errors"))


@query("anchor_table", """
SELECT o_orderkey::VARCHAR AS document_id, o_orderkey % 2 = 0 AS found_article, CASE WHEN o_orderkey % 3 = 0 THEN 'arguments' ELSE '' END AS missing, o_orderkey % 2 = 0 AND o_orderkey % 3 <> 0 AS passed FROM orders""")
def anchor_table(spark, sf_dir):
    """Articles and paths that results must hold."""
    key = F.col("o_orderkey")
    own = F.when(key % 3 == 0, F.array().cast("array<struct<paragraph_index:int,source_quote:string>>")).otherwise(F.array(F.struct(F.lit(1).alias("paragraph_index"), F.lit("q").alias("source_quote"))))
    result = F.struct(own.alias("arguments"), F.when(key % 2 == 0, "185").otherwise("186").alias("article"))
    rows = table(spark, sf_dir, "orders").select(key.cast("string").alias("document_id"), result.alias("result"))
    anchors = rows.select("document_id", F.lit("185").alias("article"), F.array(F.lit("arguments"), F.lit("article")).alias("paths"))
    return model.anchor_report(rows, PART, anchors).select("document_id", "found_article", F.array_join("missing_paths", ",").alias("missing"), "passed")


def erring_model(messages: list[dict[str, str]]) -> str:
    import json
    import re

    targets = messages[-1]["content"].split("\n\nTargets:\n", 1)[1]
    found = []
    for number, text in re.findall(r"^\[paragraph_id=(\d+)\] (.*)$", targets, re.M):
        n, quote = int(number), text[:40]
        record = {"paragraph_index": n, "source_quote": "¤ not there" if n % 5 == 0 else quote}
        content = {"arguments": [] if n % 5 == 1 else [record], "article": None}
        section = re.search(r'"([a-z]+)": \{"additionalProperties": false, "properties": \{"arguments"', messages[-1]["content"]).group(1)
        found.append({"paragraph_index": n, "source_quote": "¤ not there" if n % 5 == 2 else quote, "extraction": {section: content}, "conviction_law_articles": []})
    body = json.dumps({"observations": found}, ensure_ascii=False)
    # some answers have to be mended
    return "```json\n" + (body[:-2] + ",]}" if len(found) % 2 else body) + "\n```"


def joining_model(messages: list[dict[str, str]]) -> str:
    import json

    kept = json.loads(messages[-1]["content"])
    cited = [{"paragraph_index": k["paragraph_index"], "source_quote": k["source_quote"]} for k in kept]
    if len(kept) % 4 == 3:
        cited.append({"paragraph_index": 999999, "source_quote": "x"})
    return json.dumps({"arguments": cited, "article": None}, ensure_ascii=False)
