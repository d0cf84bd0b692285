"""What is computed once for each text, what leaves the JVM, and how much of it is Python objects at a time."""

from __future__ import annotations

import re
import unicodedata

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quillmine.functions import mojibake, rtf
from quillmine.functions import text as T
from quillmine.plans import catalogue
from quillmine.sources import sinks


def plan(df) -> str:
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")


def test_only_texts_that_composition_can_touch_leave_the_jvm(spark):
    signs = [chr(k) for k in range(0x110000) if not 0xD800 <= k < 0xE000]
    second = {unicodedata.normalize("NFD", c)[-1] for c in signs if len(unicodedata.normalize("NFD", c)) > 1}
    touched = {ord(c) for c in signs if unicodedata.combining(c) or unicodedata.normalize("NFC", c) != c or c in second}
    sign = F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32")
    rows = spark.range(0x110000).where("id < 55296 or id > 57343").select("id", sign.alias("c"))
    kept = {r.id for r in rows.where(F.col("c").rlike(T.COMPOSABLE)).select("id").collect()}
    assert touched <= kept
    plain = spark.createDataFrame([("Größe, à bientôt – «mañana» …",), ("Привіт, світе",), ("日本語",)], "t string")
    assert plain.where(F.col("t").rlike(T.COMPOSABLE)).count() == 0


def test_mended_and_composed_in_one_step(spark):
    texts = [None, "", "plain", "café ﬁn", "Ã©tÃ© naÃ¯ve", "“a”　ＡＢ́﻿\x85b", "ﬀ́", "Größe", "Ð’Ð¸Ñ€Ð¾Ðº é"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", T.mended_and_composed(F.col("t")).alias("once"), T.nfc(mojibake.mend_text(F.col("t"))).alias("twice"))
    for r in rows.collect():
        assert r.once == r.twice, r.t
    assert plan(rows.select("once")).count("ArrowEvalPython") == 1


def test_sieve_asks_for_a_sign_beyond_ascii_first():
    tried = []
    for text in ("a" * 50, "a" * 49 + "Ã©"):
        # where the sieve is tried at all: a lookahead that ends the attempt at ASCII
        tried.append([m.start() for m in re.finditer(mojibake.SIEVE.split(")", 1)[0] + ")", text)])
    assert tried == [[], [49, 50]]


@pytest.mark.parametrize("name, sign, most", [("longest_prefix", "regexp_replace(text", 2), ("paragraph_offsets_in_place", "upper(", 1)])
def test_a_text_is_made_ready_once(spark, sf, name, sign, most):
    assert 1 <= plan(catalogue.QUERIES[name](spark, sf)).split("Initial Plan")[0].count(sign) <= most


def test_short_rows_of_long_work_are_dealt_out(spark, sf):
    assert "RoundRobinPartitioning" in plan(catalogue.QUERIES["header_fields"](spark, sf))


def test_values_go_through_in_slices():
    from quillmine.functions.arrow import SLICE, mapped

    values = pa.array([None, "a", "b"] * SLICE)
    assert mapped(values, str.upper, pa.string()).to_pylist() == [None, "A", "B"] * SLICE
    assert mapped(values.slice(0, 0), str.upper, pa.string()).to_pylist() == [] and mapped(values.slice(0, 1), str.upper, pa.string()).to_pylist() == [None]
    assert mapped(values, lambda x: len(x or ""), pa.int32(), nulls=True).to_pylist() == [0, 1, 1] * SLICE


def test_many_documents_in_one_batch(spark):
    rows = spark.range(0, 1000, 1, 1).select("id", F.when(F.col("id") % 7 > 0, F.concat(F.lit(r"{\rtf1 n\u233?"), F.col("id").cast("string"), F.lit("}")).cast("binary")).alias("c"))
    got = rows.select("id", rtf.converted(F.col("c")).alias("r"), rtf.text_of_rtf(F.col("c")).alias("t")).collect()
    assert all((r.r.text, r.r.error, r.t) == ((f"né{r.id}", None, f"né{r.id}") if r.id % 7 else (None, None, None)) for r in got) and len(got) == 1000


def test_files_of_many_small_shards_are_dealt_over_tasks(spark, tmp_path):
    n = 8 * sinks.TASK_SHARDS
    rows = spark.range(n).select("id", F.lit("t").alias("text"), F.lit("train").alias("split"), F.when(F.col("id") % 2 == 0, "no").alias("error"))
    assert sinks.write_corpus(rows, f"file://{tmp_path}/c", "id", shard_rows=1) == n
    names = {re.match(r"part-(\d+)", p.name).group(1) for p in (tmp_path / "c/done").glob("shard=*/part-*")}
    assert len(names) > 4
    assert spark.read.parquet(f"file://{tmp_path}/c/done").count() == n and spark.read.parquet(f"file://{tmp_path}/c/clean").count() == n // 2


def test_letters_are_taken_out_once(spark):
    rows = spark.createDataFrame([(None,), ("",), ("1 2",), ("ab вг д",)], "t string").select(T.script_ratio(F.col("t"), "Latin").alias("r"))
    assert [r.r for r in rows.collect()] == [0.0, 0.0, 0.0, 0.4]
    assert plan(rows).count(r"\P{L}+") == 1
