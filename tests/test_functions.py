"""Literal cases of text, hashing, section, batching, nested and grounding rules."""

import hashlib
import json
import math
import random
import shutil

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as S

from quillmine import config
from quillmine.functions import grounding, hashing, nested, rtf
from quillmine.functions import text as T
from quillmine.operators import batching, graph, html_header, paragraphs, sampling, sections, tracking, vocabulary
from quillmine.sources import files, sinks
from quillmine.streaming import incremental


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"`{k}` {'array<string>' if isinstance(v, list) else 'int' if isinstance(v, int) else 'string'}" for k, v in values.items())) if values else spark.range(1)
    return df.select(column.alias("v")).first().v


def test_normalization(spark):
    text = "á\r\nb  \x07c  \r\r\n\n\n d​ \x1f "
    assert one(spark, T.normalize_plain(F.col("t")), t=text) == "á\nb  c\n\n d​"
    assert one(spark, T.normalize_dense(F.col("t")), t=text) == "á\nb c\n\nd"
    assert one(spark, T.normalize_light(F.col("t")), t="a \t\r\nb\n\n\n\nc ") == "a\nb\n\nc"
    assert one(spark, T.header_text(F.col("t")), t=" a&amp;b&nbsp; c d ") == "a&b c d"
    assert one(spark, T.header_text(F.col("t")), t=None) == ""
    assert one(spark, T.paragraphs(F.col("t")), t=" a \n\n\t\nb \n") == ["a", "b"]
    assert one(spark, T.blank_line_paragraphs(F.col("t")), t="a\nb\n \n\nc\n\n") == ["a b", "c"]


def test_dates_values_and_tags(spark):
    assert one(spark, T.clean_date(F.col("t")), t=" 01.02.2024. ") == "01.02.2024"
    assert one(spark, T.clean_value(F.col("t")), t="   ") is None
    tags = {"ВСТАНОВИВ:": "FACTS_BEGIN", "УХВАЛИВ:": "RULING_BEGIN", "керуючись ст. 1": "LEGAL_BASIS", " вирок ": "TITLE", "інше": None}
    assert {t: one(spark, T.section_tag(F.col("t")), t=t) for t in tags} == tags
    assert one(spark, T.without_case_number(F.col("t")), t="154/31/21: Крадіжка") == "Крадіжка"
    assert one(spark, T.without_case_number(F.col("t")), t="Крадіжка: інше") == "Крадіжка: інше"
    assert one(spark, T.labelled_value(F.col("t"), "Aa", ("Bb",)), t="x Aa : one two Bb: three") == "one two"
    assert one(spark, T.file_name(F.col("t"), F.lit("9")), t="https://x.y/a/b.rtf?q=/z") == "b.rtf"
    assert one(spark, T.file_name(F.col("t"), F.lit("9")), t="https://x.y/a/") == "9.bin"
    assert one(spark, T.script_ratio(F.col("t")), t="Іван & John") == 0.5 and one(spark, T.script_ratio(F.col("t")), t="") == 0.0


def test_metadata(spark):
    m = one(spark, T.metadata(F.col("p")), p=["Справа № 154/3125/21", "Провадження  x № 1-кс/154", "5 січня 2024 року м. Одеса", "Суддя", "Районний СУД міста"])
    assert tuple(m) == ("154/3125/21", "1-кс/154", "05 січня 2024", "2024-01-05", "Одеса", "Районний СУД міста")
    m = one(spark, T.metadata(F.col("p")), p=["154/3125/21 ", "слово 12-кс/9 кінець", "судова справа"])
    assert tuple(m) == ("154/3125/21", "12-кс/9", None, None, None, None)


def test_mojibake(spark):
    good = "Вирок №1 «суд»"
    assert one(spark, T.repair_cp1251(F.col("t")), t=good.encode("cp1251").decode("latin-1")) == good
    assert one(spark, T.undecodable_cp1251(F.col("t")), t="a\u0098")


def test_hashes(spark):
    expected = int.from_bytes(hashlib.sha256(b"42:77").digest()[:8], "big")
    assert int(one(spark, hashing.stable_hash(F.col("t"), 42), t="77")) == expected
    assert one(spark, hashing.split_of(F.col("t"), 0.5, 42), t="77") == ("validation" if expected % 10_000 < 5000 else "train")
    assert hashing.quota_per_kind(900, 0.10, 4) == 25 and hashing.quota_per_kind(0, 0.1, 4) == 0
    with pytest.raises(ValueError):
        hashing.quota_per_kind(1, 1.0, 4)


def test_rtf():
    u = b"\\u1081"  # a Cyrillic letter by its number
    data = rb"{\rtf1\ansi\ansicpg1251{\fonttbl{\f0 Times;}}{\*\generator x;}\f0\b \'c2\'e8\'f0\'ee\'ea\b0\par" + u + rb"?\uc0" + u + rb" z\line\{a\}\tab b}"
    assert rtf.rtf_text(data) == "Вирок\nйй" + "z\n{a}\tb" and rtf.rtf_text(None) is None


def plain_chunks(sizes, most):
    chunks, held, n = [], [], 0
    for k, size in enumerate(sizes, 1):
        add = size + (2 if held else 0)
        if held and n + add > most:
            chunks.append((held[0], held[-1]))
            held, n = [], 0
        held.append(k)
        n += add
    return chunks + ([(held[0], held[-1])] if held else [])


def plain_batches(sizes, budget, overlap):
    found, at = [], 0
    while at < len(sizes):
        lead = at
        while overlap > 0 and lead > 0 and sum(sizes[lead:at]) < overlap:
            lead -= 1
        used, end = sum(sizes[lead:at]), at
        while end < len(sizes) and (end == at or used + sizes[end] <= budget):
            used += sizes[end]
            end += 1
            if end == at + 1 and used > budget:
                break
        found.append((len(found) + 1, lead + 1, at + 1, end, used))
        at = end
    return found


def test_chunks_and_batches(spark):
    r = random.Random(3)
    lists = [[5, 5, 5], [20], [], [20, 1, 1, 1]] + [[r.randint(1, 14) for _ in range(r.randint(1, 25))] for _ in range(60)]
    df = spark.createDataFrame([(k, ["x" * n for n in sizes]) for k, sizes in enumerate(lists)], "k int, parts array<string>")
    got = {x.k: [(c.p_from, c.p_to) for c in x.c] for x in df.select("k", paragraphs.char_chunks(F.col("parts"), 12).alias("c")).collect()}
    for k, sizes in enumerate(lists):
        assert got[k] == plain_chunks(sizes, 12), sizes
        for overlap in (0, 3, 100):
            assert batching.batches_of(sizes, 12, overlap) == plain_batches(sizes, 12, overlap)
    with pytest.raises(ValueError):
        batching.batches_of([1], 0, 0)


def test_token_windows(spark):
    ids = spark.createDataFrame([(list(range(1, 17)),), ([],)], "ids array<int>")
    got = [[list(w.input_ids) for w in r.w] for r in ids.select(paragraphs.token_windows(F.col("ids"), 7, 2).alias("w")).collect()]
    assert got == [[[101, *range(a, a + 5), 102] for a in (1, 6, 11)], []]


def test_offsets_by_both_ways(spark):
    docs = spark.createDataFrame([(1, "ab\n\ncde\n\n\nf"), (2, ""), (3, "x")], "doc_id long, text string")
    table = sorted((r.doc_id, r.p, r.start, r.end, r.text) for r in paragraphs.offset_table(docs).collect())
    folded = docs.select("doc_id", F.inline(paragraphs.with_offsets(T.blank_line_paragraphs(T.normalize_light(F.col("text"))))))
    assert table == sorted((r.doc_id, r.p, r.start, r.end, r.text) for r in folded.collect()) == [(1, 1, 0, 2, "ab"), (1, 2, 4, 7, "cde"), (1, 3, 9, 10, "f"), (3, 1, 0, 1, "x")]


def test_sections(spark):
    names = ["introductory", "descriptive", "introductory", "reasoning", "operative", "reasoning"]
    df = spark.createDataFrame([(1, k, s) for k, s in enumerate(names)], "d int, k int, section string")
    got = [r.effective_section for r in sections.monotone_sections(df, "d", "k", "section").orderBy("k").collect()]
    assert got == ["introductory", "reasoning", "reasoning", "reasoning", "operative", "operative"]
    with pytest.raises(Exception, match="unsupported section"):
        sections.monotone_sections(df.withColumn("section", F.lit("x")), "d", "k", "section").collect()
    keys = spark.createDataFrame([(1, k, c, c != "-") for k, c in enumerate("aab-ba")], "d int, k int, c string, s boolean")
    assert [r.group_id for r in sections.islands(keys, "d", "k", F.col("s"), F.col("c")).orderBy("k").collect()] == [1, 1, 2, 3, 4]
    assert {r.group_id for r in sections.islands(keys, "d", "k", F.col("s"), mode="filtered").collect()} == {1}


def test_tracking(spark):
    left = spark.createDataFrame([("1", "a"), ("1", "b"), (None, "c"), ("2", "d")], "id string, v string")
    assert sorted(r.v for r in tracking.missing_in(left, spark.createDataFrame([(2,)], "id long"), "id").collect()) == ["a", "b"]
    assert {(r.c, r.n) for r in tracking.category_frequency(spark.createDataFrame([("x",), ("x",), (None,)], "c string"), "c").collect()} == {("x", 2), (None, 0)}
    rows = spark.range(1000).withColumn("id", F.col("id") * 3)
    assert all(r.position == r.id // 3 for r in tracking.positions(rows, "id").collect())
    with pytest.raises(ValueError):
        tracking.table_or_empty(spark, "t", "bad name")
    assert tracking.table_or_empty(spark, "no_such_table", "id").count() == 0


def test_positions_of_any_type_and_size(spark):
    """Text, null and composite ids; one path at every size."""
    for n in (0, 1, 7, 200_000):
        rows = spark.range(n).select(F.when(F.col("id") != 3, F.concat(F.lit("d"), (F.col("id") * 7919 % 200_003).cast("string"))).alias("key"))
        got = {r.position: r.key for r in tracking.positions(rows.repartition(5), "key").collect()}
        plain = sorted((r.key for r in rows.collect()), key=lambda k: (k is not None, k or ""))
        assert [got[k] for k in range(n)] == plain and len(got) == n
    pairs = spark.createDataFrame([(k % 3, f"n{k}", k) for k in range(500)], "a int, b string, size long")
    got = [r.gone for r in tracking.running_total(pairs, "size", "a", "b", name="gone").orderBy("a", "b").collect()]
    sizes = [k for _, _, k in sorted((k % 3, f"n{k}", k) for k in range(500))]
    assert got == [sum(sizes[:k]) for k in range(500)]


def test_first_steps_of_a_run(spark):
    rows = spark.createDataFrame([(1, "u", 0.0), (2, "", float("nan")), (0, "v", 1.0), (None, "w", 1.0), (5, None, 2.0), (6, "x", None)], "id int, url string, x double")
    assert [r.id for r in tracking.with_required(rows, "id", "url").orderBy("id").collect()] == [1, 6]
    assert [r.id for r in rows.where(tracking.is_given(rows, "x")).orderBy("id").collect()] == [None, 0, 2, 5]
    assert [r.id for r in tracking.first_rows(rows.where("id is not null"), "id", 2).collect()] == [0, 1] and tracking.first_rows(rows, "id").count() == 6
    assert tracking.missing_columns(rows, ["z", "id", "a"]) == ["a", "z"]
    assert one(spark, tracking.missing_names(F.split("e", ","), F.split("o", ",")), e="b,a,b,c", o="a") == ["b", "c"]


def test_lowest_ranked(spark):
    items = [(f"d{k}", "ab"[k % 2]) for k in range(40)]
    got = sampling.lowest_ranked(spark.createDataFrame(items, "id string, kind string"), "id", 7, 5, ["kind"]).collect()
    for kind in "ab":
        rank = sorted((int.from_bytes(hashlib.sha256(f"7:{d}".encode()).digest()[:8], "big"), d) for d, k in items if k == kind)[:5]
        assert [r.id for r in sorted(got, key=lambda r: r.rank) if r.kind == kind] == [d for _, d in rank]


def test_vocabulary(spark):
    base = spark.createDataFrame([("a", 0), ("b", 1)], "token string, id int")
    candidates = spark.createDataFrame([("b", 1), ("c", 2), ("d", 3), ("c", 4)], "token string, place int")
    assert sorted((r.token, r.id) for r in vocabulary.merged(base, candidates, 1).collect()) == [("a", 0), ("b", 1), ("c", 2)]
    assert vocabulary.merged(base, candidates, 0).count() == 3
    with pytest.raises(ValueError):
        vocabulary.merged(base.where("id = 1"), candidates, 1)


def test_graph(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (3, 4), (2, 1), (4, 4)], "src long, dst long")
    assert {r.node: (r.degree, r.triangles, round(r.coefficient, 4)) for r in graph.clustering(edges).collect()} == {1: (2, 1, 1.0), 2: (2, 1, 1.0), 3: (3, 1, 0.3333), 4: (1, 0, 0.0)}
    assert graph.average_degree(edges).first()[0] == 2.0
    assert {(r.src, r.dst) for r in graph.missing_edges(graph.degrees(edges).select("node"), edges).collect()} == {(1, 4), (2, 4)}
    ranks = {r.node: r.rank for r in graph.pagerank(edges, 0.8, 1).collect()}
    assert ranks[4] == pytest.approx(0.8 * 0.25 / 3 + 0.05)
    assert one(spark, graph.perplexity(F.lit(60.0))) == math.inf
    assert one(spark, graph.edge_score(F.array(F.lit(1.0), F.lit(2.0)), F.array(F.lit(0.5), F.lit(0.0)))) == pytest.approx(1 / (1 + math.exp(-0.5)))


def test_header_tables(spark):
    page = "<table id=x><tr><td>n</td></tr></table><table id='info'><tr><td>Категорія справи № <b>1/2/21: Крадіжка</b></td></tr><tr><td>Надіслано судом: <b>1.</b> Зареєстровано: <b>2.</b> Забезпечено надання загального доступу: <b>3.</b></td></tr><tr><td>out<table><tr><td>in</td></tr></table></td></tr></table>"
    df = spark.createDataFrame([(page,), ("<p>",), (None,), ("<table id='info'><tr><td>unclosed",)], "html string")
    got = html_header.header_fields(df).collect()
    assert (got[0].case_category, got[0].sent_by_court, got[0].registered, got[0].public_access_provided) == ("Крадіжка", "1", "2", "3")
    assert all(r.case_category is None and r.registered is None for r in got[1:])
    assert [r["text"] for r in html_header.rows_of_table(page)][-1] != "out"

    def fetch(url):
        if url == "bad":
            raise OSError("no")
        return 200, page

    rows = html_header.fetched(spark.createDataFrame([("ok",), ("bad",)], "url string"), "url", fetch).orderBy("url").collect()
    assert [(r.status, r.fetch_error) for r in rows] == [(None, "OSError: no"), (200, None)]


def test_json_answers(spark):
    parse = lambda t: one(spark, nested.parsed_object(F.col("t"), "a int"), t=t)
    assert parse('{"a": 3,}').value.a == 3 and parse('{"a": 3,').error == "not JSON or cut off"
    assert parse('```json\n{"a": 1}\n```').value.a == 1 and parse('{"a": 1').error == "not JSON or cut off" and parse("[1]").error == "not an object" and parse('{"a" 1}').error == "broken object"
    assert one(spark, nested.repaired(F.col("t")), t='{"a": [1,],}') == '{"a": [1]}'
    assert one(spark, nested.text_field(F.col("t")), t='["ст. 65 КК України", null, " ст. 75 КК України "]') == "ст. 65 КК України; ст. 75 КК України"
    assert one(spark, nested.text_field(F.col("t")), t='[null, "  "]') is None


KIND = S.StructType([
    S.StructField("name", S.StringType(), False), S.StructField("n", S.IntegerType()), S.StructField("flag", S.BooleanType()), S.StructField("tags", S.ArrayType(S.StringType())),
    S.StructField("items", S.ArrayType(S.StructType([S.StructField("paragraph_index", S.IntegerType()), S.StructField("q", S.StringType())]))), S.StructField("inner", S.StructType([S.StructField("x", S.DoubleType())])),
])


def test_schema_walks(spark):
    contract = nested.struct_contract(KIND)
    assert contract["required"] == ["name"] and contract["properties"]["n"] == {"type": ["integer", "null"]} and contract["additionalProperties"] is False
    check = lambda v: one(spark, nested.checked_payload(F.col("t"), KIND), t=json.dumps(v))
    good = check({"name": ["a ", None, "b"], "items": [{"paragraph_index": 1, "extra": 2}]})
    assert good.errors == [] and json.loads(good.payload)["name"] == "a; b" and json.loads(good.payload)["items"] == [{"paragraph_index": 1, "q": None}]
    assert check({"name": "a", "n": 2**40}).errors == ["payload.n is out of range"] and check({"name": "a", "n": True}).errors == ["payload.n must be an integer"]
    assert check({"zzz": 1}).errors == ["unexpected fields: ['zzz']"] and check({}).errors == ["payload.name is required"]
    df = spark.createDataFrame([(("a", 1, None, ["x"], [(3, "q"), (1, " ")], (None,)),), (("b", None, True, [], None, None),)], S.StructType([S.StructField("v", KIND)]))
    report = {r.path: (r.populated_values, r.observed_values) for r in nested.population_report(df.select("v.*")).collect()}
    assert report == {"name": (2, 2), "n": (1, 2), "flag": (1, 2), "tags": (1, 2), "items": (1, 2), "items[].paragraph_index": (2, 2), "items[].q": (1, 2), "inner": (1, 2), "inner.x": (0, 1)}
    assert [r.p for r in df.select(nested.paragraph_indexes(F.col("v"), KIND).alias("p")).collect()] == [[1, 3], []]
    merged = df.agg(F.min_by("v", F.col("v.name")).alias("a"), F.max_by("v", F.col("v.name")).alias("b")).select(nested.merged(F.col("a"), F.col("b"), KIND).alias("m"), nested.merge_conflicts(F.col("a"), F.col("b"), KIND, "p").alias("c")).first()
    assert (merged.m.name, merged.m.n, merged.m.flag, merged.m.tags, merged.c) == ("a", 1, True, ["x"], ["p.name"])


def test_grounding(spark):
    source = "The quick, brown fox jumps over the dog."
    cases = {"quick, brown": None, "The fox  dog": None, "fox quick": "not", "cat": "not", "  ": "empty"}
    for quote, expected in cases.items():
        error = one(spark, grounding.grounding_error(F.col("q"), F.col("s")), q=quote, s=source)
        assert error is None if expected is None else error.startswith(expected), (quote, error)
    assert one(spark, grounding.longest_prefix(F.col("q"), F.col("s")), q="quick, browse", s=source) == len("quick, brow")
    r = random.Random(1)
    for _ in range(20):
        q, s = ("".join(r.choice("ab ") for _ in range(n)) for n in (4, 12))
        expected = max(n for n in range(len(q) + 1) if q[:n] in s)
        assert one(spark, grounding.longest_prefix(F.col("q"), F.col("s")), q=q, s=s) == expected


def test_nested_grounding(spark):
    """Records inside an observation: foreign paragraphs, missing and wrong quotes, in lists and structs at any depth."""
    record = S.StructType([S.StructField("paragraph_index", S.IntegerType()), S.StructField("source_quote", S.StringType())])
    kind = S.StructType([S.StructField("list", S.ArrayType(S.StructType([*record, S.StructField("deep", record)]))), S.StructField("one", record)])
    schema = S.StructType([S.StructField("name", S.StringType()), S.StructField("v", kind)])
    cases = {
        "fine": ((1, "red fox", None), None), "no quote for the outer one": ((1, None, None), None), "another paragraph": ((2, "blue", None), None),
        "another without a quote": ((2, " ", None), "v.list[0]: source_quote is required for another paragraph"), "unknown": ((7, "red", None), "v.list[0]: paragraph_index must name a target"),
        "wrong quote": ((1, "blue", None), "v.list[0]: not a quote"), "no number": ((None, "red", None), "v.list[0]: paragraph_index must name a target"), "deep": ((1, "red", (2, "fox")), "v.list[0].deep: not a quote"),
    }
    df = spark.createDataFrame([(n, ([v], (1, "a red"))) for n, (v, _) in cases.items()], schema)
    texts = F.array(F.lit("a red fox"), F.lit("the blue sky"))
    error = grounding.nested_error(nested.citations(F.col("v"), kind, F.lit("v")), F.lit(1), F.array(F.lit(1), F.lit(2)), texts)
    for r in df.select("name", error.alias("e")).collect():
        wanted = cases[r.name][1]
        assert r.e is None if wanted is None else r.e.startswith(wanted), (r.name, r.e)
    other = spark.createDataFrame([(([(1, "red", None)], (2, "")),), (None,)], S.StructType([S.StructField("v", kind)]))
    assert [r.e for r in other.select(error.alias("e")).collect()] == ["v.one: source_quote is required for another paragraph", None]


def test_calls_and_their_context(spark):
    from quillmine.operators import model

    prompts = spark.createDataFrame([("d", "one two three")], "document_id string, prompt string")
    asked = lambda answer, **call: model.answered(prompts, lambda messages: answer, **call).first()
    assert asked('{"a": 1}', context_tokens=10, most_new_tokens=7).error is None
    assert asked('{"a": 1}', context_tokens=10, most_new_tokens=8).calls == 0
    assert json.loads(asked('{"a": 1,}').answer) == {"a": 1} and asked('{"a": 1').calls == 2 and asked("[1]", retries=0).error == "the answer must be an object"


def test_masking(spark):
    from quillmine.operators import vocabulary

    df = spark.createDataFrame([(k, [int(x) for x in range(1000, 1100)]) for k in range(100)], "n int, ids array<int>")
    rows = vocabulary.masked(df.withColumn("ids", F.transform("ids", lambda x: x + F.col("n"))), "ids", 5, 3, 500).collect()
    asked = [(x, m, y) for r in rows for x, m, y in zip(r.ids, r.masked, r.labels)]
    drawn = [(x, m) for x, m, y in asked if y != -100]
    assert all(y in (-100, x) and (y != -100 or m == x) for x, m, y in asked) and 0.13 < len(drawn) / len(asked) < 0.17
    assert 0.75 < sum(m == 3 for _, m in drawn) / len(drawn) < 0.85 and 0.06 < sum(m == x for x, m in drawn) / len(drawn) < 0.14


def test_listings(spark):
    names = spark.createDataFrame([("1/a.rtf",), ("1/b.RTF",), ("2/c.txt",), ("p/9/result.parquet",), ("p/9/x/result.parquet",)], "name string")
    assert sorted(r.doc_id for r in files.listed_ids(names).collect()) == ["a", "b"]
    assert [r.doc_id for r in files.available_ids(names).collect()] == ["1/a"]
    assert [r.doc_id for r in files.completed_ids(names, "p/").collect()] == ["9"]


def test_files_sinks_and_streams(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "7.rtf").write_bytes(rb"{\rtf1 a\par b}")
    assert [(r.doc_id, r.text) for r in files.rtf_documents(spark, str(tmp_path / "in")).collect()] == [("7", "a\nb")]
    rows = spark.createDataFrame([(k, f"t{k}", "train" if k % 3 else "validation", "bad" if k == 4 else None) for k in range(10)], "doc_id long, text string, split string, error string")
    assert sinks.write_corpus(rows, str(tmp_path / "out"), "doc_id", shard_rows=4) == 3
    back = spark.read.parquet(str(tmp_path / "out" / "clean"))
    assert back.count() == 9 and {r.shard for r in back.collect()} == {0, 1, 2}
    assert [t.text for t in files.clean_texts(spark, str(tmp_path / "out" / "clean"), 3).collect()] and spark.read.parquet(str(tmp_path / "out" / "errors")).count() == 1
    assert all((tmp_path / "out" / "clean" / f"split={split}" / f"shard={n}").is_dir() for split in ("train", "validation") for n in range(3)) and all((tmp_path / "out" / "errors" / f"shard={n}").is_dir() for n in range(3))
    # a rerun leaves finished shards alone and computes only the others, without leftovers of theirs
    calls = spark.sparkContext.accumulator(0)

    def worse(df):
        @F.udf("string")
        def refuse(k):
            calls.add(1)
            return "now bad"

        return df.drop("error").withColumn("error", refuse("doc_id"))

    shutil.rmtree(tmp_path / "out" / "done" / "shard=1")
    assert sinks.write_corpus(rows, str(tmp_path / "out"), "doc_id", worse, shard_rows=4) == 1 and calls.value == 4
    assert sinks.write_corpus(rows, str(tmp_path / "out"), "doc_id", worse, shard_rows=4) == 0
    clean, errors = spark.read.parquet(str(tmp_path / "out" / "clean")), spark.read.parquet(str(tmp_path / "out" / "errors"))
    assert sorted(r.doc_id for r in clean.collect()) == [0, 1, 2, 3, 8, 9] and sorted(r.doc_id for r in errors.collect()) == [4, 5, 6, 7]
    assert sinks.write_marker(spark, str(tmp_path / "m"), {"b": 1}) and not sinks.write_marker(spark, str(tmp_path / "m"), {"b": 2})
    (tmp_path / "tree" / "sub").mkdir(parents=True)
    (tmp_path / "tree" / "sub" / "a.json").write_bytes(b"{}")
    (tmp_path / "tree" / "result.parquet").write_bytes(b"x")
    assert sinks.copy_tree(spark, str(tmp_path / "tree"), str(tmp_path / "copy")) == 1 and (tmp_path / "copy" / "sub" / "a.json").read_bytes() == b"{}"
    assert spark.read.option("header", "true").csv(sinks.write_result_log(rows, str(tmp_path / "log"), "20240101")).count() == 10
    settings = config.PreparationSettings()
    sinks.check_identity(spark, str(tmp_path / "id"), config.identity(settings))
    sinks.check_identity(spark, str(tmp_path / "id"), config.identity(settings))
    with pytest.raises(ValueError):
        sinks.check_identity(spark, str(tmp_path / "id"), config.identity(settings, more=1))
    sinks.check_identity(spark, str(tmp_path / "id2"), "x", {"rows": 3})
    sinks.check_identity(spark, str(tmp_path / "id2"), "x", {"rows": 3})
    with pytest.raises(ValueError, match="another manifest"):
        sinks.check_identity(spark, str(tmp_path / "id2"), "x", {"rows": 4})
    source, target = str(tmp_path / "s"), str(tmp_path / "t")
    for start in (0, 5):
        spark.range(start, start + 5).write.mode("append").parquet(source)
        incremental.process_new(spark, source, "id long", target, str(tmp_path / "c"), lambda d: d.withColumn("twice", F.col("id") * 2))
    assert sorted(r.twice for r in spark.read.parquet(target).collect()) == list(range(0, 20, 2))


def test_logs_results_and_blobs(spark, tmp_path):
    events = spark.createDataFrame([(k, "ok" if k % 3 else "failed") for k in range(25)], "n long, status string")
    summary = sinks.write_run_log(events, str(tmp_path / "log"), "n", "status", 10)
    assert summary == {"total": 25, "by_status": {"failed": 9, "ok": 16}}
    lines = spark.read.text(str(tmp_path / "log" / "events")).groupBy("shard").count().collect()
    assert {r.shard: r["count"] for r in lines} == {"events-000001.jsonl": 10, "events-000002.jsonl": 10, "events-000003.jsonl": 5}
    (tmp_path / "a").write_bytes(b"x" * 3000)
    assert files.copy_blob(spark, str(tmp_path / "a"), str(tmp_path / "b"), chunk=100) and (tmp_path / "b").read_bytes() == b"x" * 3000
    assert not files.copy_blob(spark, str(tmp_path / "a"), str(tmp_path / "b"))
    with pytest.raises(FileNotFoundError):
        files.copy_blob(spark, str(tmp_path / "none"), str(tmp_path / "c"))
    assert [sinks.disposition("truncate", k == 0) for k in range(2)] == ["truncate", "append"]
    with pytest.raises(ValueError):
        sinks.disposition("empty", True, workers=2)
    messages = F.array(F.struct(F.lit("user").alias("role"), F.lit("two words").alias("content")), F.struct(F.lit("assistant").alias("role"), F.lit("one").alias("content")))
    assert one(spark, T.chat_token_count(messages)) == 3 and one(spark, T.chat_token_count(messages, lambda m: F.lit("a b c d"))) == 4
    frequency = tracking.category_frequency(spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,)], "c string"), "c").collect()
    assert [(r.c, r.n) for r in frequency] == [("c", 2), ("a", 1), ("b", 1), (None, 0)]
    assert [r.id for r in vocabulary.in_order(spark.createDataFrame([("b", 1), ("a", 2), ("c", 0)], "token string, id long")).collect()] == [0, 1, 2]


def test_settings():
    config.PreparationSettings().validate()
    config.ExtractionSettings().validate()
    for bad in (config.PreparationSettings(validation_fraction=2), config.PreparationSettings(compression="x"), config.ExtractionSettings(overlap_tokens=9000), config.ExtractionSettings(table="a b")):
        with pytest.raises(ValueError):
            bad.validate()
    assert config.accumulation_steps(24) == 3 and config.batch_for_memory(80) == 64 and config.batch_for_memory(None) == 4
