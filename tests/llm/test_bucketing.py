"""Co-bucketed tables: every file against plain code, from the files as they lie there."""

import collections
import datetime
import hashlib
import os
import random
import zlib

import pyarrow.parquet as pq
import pytest

from quillmine.llm import bucketing, queries


def crc(text):
    return zlib.crc32(text.encode()) % bucketing.BUCKETS


@pytest.fixture
def few(monkeypatch):
    """Fewer buckets, for speed."""
    for name, n in (("BUCKETS", 40), ("ORPHANS", 40), ("NULLS", 41), ("NUMBERS", 42)):
        monkeypatch.setattr(bucketing, name, n)


def sha(parts):
    return hashlib.sha256(",".join(parts).encode()).hexdigest()


def sort_key(row, names):
    """sale_id descending, the rest ascending, nulls first, texts by bytes."""
    at = names.index("sale_id")
    plain = lambda v: (v is not None, v.encode() if isinstance(v, str) else v if v is not None else 0)
    own = row[at]
    return [(own is not None, -(own or 0)), *[plain(v) for k, v in enumerate(row) if k != at]]


def plain(tables):
    """(table, bucket) to (rows, rows by starting file); and pairs by bucket."""
    n_sales = collections.Counter(r["sale_id"] for r in tables["sales"] if r["sale_id"] is not None)
    files, joined = collections.defaultdict(lambda: ([], collections.Counter())), collections.Counter()
    for name, rows in tables.items():
        for r in rows:
            key = r["sale_id"]
            b = bucketing.NULLS if key is None else crc(f"s{key}") if name == "sales" or key in n_sales else bucketing.ORPHANS
            start = (b - 1 if b % 4 == 1 else b) if name == "sales" else 0 if r["item_id"] is None else crc(str(r["item_id"]))
            files[name, b][0].append(tuple(r.values()))
            files[name, b][1][start] += 1
            if name == "sale_lines" and key in n_sales:
                joined[b] += n_sales[key]
    return files, joined


def held(spark, found, tables):
    files, joined = plain(tables)
    in_start = collections.Counter((name, s) for (name, _), (_, came) in files.items() for s in came)
    got = {(r.table_name, r.bucket): r for r in found.collect()}
    assert set(got) == set(files)
    folders = {os.path.dirname(r.path) for r in got.values()}
    on_disk = {f"{f}/{n}" for f in folders for n in os.listdir(f.removeprefix("file://")) if not n.startswith(".")}
    assert on_disk == {r.path for r in got.values()}
    for (name, b), (rows, came) in files.items():
        r = got[name, b]
        names = list(tables[name][0])
        rows = sorted(rows, key=lambda x: sort_key(x, names))
        there = pq.read_table(r.path.removeprefix("file://"))
        assert there.column_names == names == r.columns.split(",")
        assert [tuple(x.values()) for x in there.to_pylist()] == rows and r.n_rows == len(rows) > 0
        at = names.index("sale_id")
        assert r.ids_sha256 == sha("" if x[at] is None else str(x[at]) for x in rows)
        assert r.lineage_sha256 == sha(f"{s}:{n}" for s, n in sorted(came.items()))
        assert r.n_joined == joined[b]
        assert r.rewritten == (not (len(came) == 1 and in_start[name, next(iter(came))] == 1))
    return got


def test_surrogates_hit_every_partition_once(spark):
    keys = bucketing.surrogates(spark, 37)
    assert len(set(keys)) == 37
    from pyspark.sql import functions as F

    rows = bucketing.dealt(spark.range(37), F.col("id"), keys).withColumn("task", F.spark_partition_id())
    assert all(r.id == r.task for r in rows.collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_odd_tables(spark, tmp_path, few, seed):
    """Nulls in every column, repeated rows, unknown and null keys, columns named like the module's own."""
    luck = random.Random(seed)
    some = lambda *v: luck.choice([None, *v])
    when = datetime.datetime(2024, 1, 1)
    ids = luck.sample(range(-50, 5000), 40)
    sales = [(some("é", "z", "", "日本"), luck.choice([*ids, None]), some(1.5, -2.0), some(when), some(3, 4), some("x")) for _ in range(60 * seed)]
    lines = [(luck.choice([*ids[:25], None, 9999, 10_001]), some(1, 2), some(7, 8, 9), some("p"), some("q")) for _ in range(90)]
    sales, lines = sales + sales[:9], lines + lines[:9]
    names = {"sales": "row string, sale_id long, bucket double, number timestamp_ntz, place int, path string", "sale_lines": "sale_id long, known int, item_id long, key string, table_name string"}
    tables = {}
    for name, rows in (("sales", sales), ("sale_lines", lines)):
        df = spark.createDataFrame(rows, names[name])
        df.write.parquet(f"{tmp_path}/{name}.parquet")
        tables[name] = [dict(zip(df.columns, r)) for r in rows]
    got = held(spark, queries.op13_co_bucketed(spark, str(tmp_path)), tables)
    assert any(not r.rewritten for r in got.values()) and any(r.rewritten for r in got.values())


def test_empty_tables(spark, tmp_path, few):
    sales, lines = spark.createDataFrame([(5,), (None,)], "sale_id long"), spark.createDataFrame([], "sale_id long, item_id long")
    found = bucketing.co_bucketed(spark, sales, lines, f"file://{tmp_path}/one")
    assert {(r.bucket, r.n_rows, r.n_joined, r.rewritten) for r in found.collect()} == {(crc("s5"), 1, 0, False), (41, 1, 0, False)}
    assert not bucketing.co_bucketed(spark, sales.limit(0), lines, f"file://{tmp_path}/two").collect()


def test_the_given_tables(spark, sf):
    tables = {n: [r.asDict() for r in spark.read.parquet(f"{sf}/{n}.parquet").collect()] for n in ("sales", "sale_lines")}
    held(spark, queries.op13_co_bucketed(spark, sf), tables)
