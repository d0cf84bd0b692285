"""Mechanisms held against plain code: mended readings, positions, folds, ranks, samples, shards, components."""

import collections
import itertools
import json
import os
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillmine.functions import mojibake, nested
from quillmine.functions.hashing import permuted
from quillmine.operators import graph, paragraphs, sampling, tracking
from quillmine.plans import catalogue
from quillmine.plans.corpus import cleaned
from quillmine.sources import sinks

TRUE_TEXTS = ["Вирок суду № 5 — «так», ї", "café à Ârbol – “ok”", "日本語 тест", "plain", "", "Straße € 5", "ё — е"]
LOOK_ALIKES = ["«CAFÉ»", "Рівне, СІ, тіло вії її", "«BLÅ»", "Ã", "5 °C Â", "Рішення суду від 5 січня — «Різдво»", "éà ÄÖÜ»"]


def read_as(text, code):
    return "".join(mojibake.READ_AS[code][b] for b in text.encode())


def test_wrong_readings_are_undone(spark):
    chains = [c for n in (1, 2, 3) for c in itertools.product(mojibake.CODES, repeat=n)]
    for text, chain in itertools.product(TRUE_TEXTS[:1] + TRUE_TEXTS[2:3], chains):
        broken = text
        for code in chain:
            broken = read_as(broken, code)
        assert mojibake.mended(broken) == text, (text, chain)
    for text in TRUE_TEXTS + LOOK_ALIKES:
        assert mojibake.mended(text) == text
        assert mojibake.mended(f"{text} | {read_as('Вирок суду', 'cp1251')}") == f"{text} | Вирок суду"
    rows = spark.createDataFrame([(k, t) for k, t in enumerate([*TRUE_TEXTS, None])], "k int, t string")
    for code in mojibake.CODES:
        broken = {r.k: r.b for r in rows.select("k", mojibake.misread(F.col("t"), code).alias("b")).collect()}
        assert broken == {k: None if t is None else read_as(t, code) for k, t in enumerate([*TRUE_TEXTS, None])}
    assert [r.t for r in rows.select(mojibake.mend(F.col("t")).alias("t")).collect()] == [*TRUE_TEXTS, None]
    signs = spark.createDataFrame([("‘a’ “b” ﬁn Ａ１ \x85x﻿",)], "t string")
    assert signs.select(mojibake.plain_signs(F.col("t")).alias("t")).first().t == "'a' \"b\" fin A1 \nx"


def test_positions_with_any_names(spark):
    rows = spark.createDataFrame([(k % 3, k, 10 - k, "x", "y") for k in range(9)], "`a.b` int, _part int, _at int, _base string, row string")
    found = tracking.positions(rows, "a.b", "_part", name="place")
    assert found.columns == [*rows.columns, "place"]
    assert [(r["a.b"], r._part) for r in sorted(found.collect(), key=lambda r: r.place)] == sorted((k % 3, k) for k in range(9))
    total = tracking.running_total(rows, "_at", "a.b", "_part", name="_base")
    assert total.columns == ["a.b", "_part", "_at", "row", "_base"]
    upto, want = 0, {}
    for r in sorted(rows.collect(), key=lambda r: (r["a.b"], r._part)):
        want[r._part] = upto
        upto += r._at
    assert {r._part: r._base for r in total.collect()} == want


def test_places_by_falling_count(spark):
    rows = spark.createDataFrame([("b", 3, "x"), (None, 3, "y"), ("a", 3, "z"), ("c", 9, "w"), ("d", None, "v")], "`k.1` string, n long, falling string")
    found = tracking.ranked(rows, "k.1", name="falling")
    assert found.columns == ["k.1", "n", "falling"] and [r["k.1"] for r in sorted(found.collect(), key=lambda r: r.falling)] == ["d", "c", None, "a", "b"]


def test_documents_of_very_many_paragraphs(spark):
    one = spark.range(1).select(F.transform(F.sequence(F.lit(1), F.lit(100_000)), lambda k: F.lit("abc")).alias("parts"))
    start = time.time()
    chunks = one.select(F.inline(paragraphs.char_chunks(F.col("parts"), 53)))
    placed = one.select(F.inline(paragraphs.with_offsets(F.col("parts"))))
    assert chunks.count() == 10_000 and placed.agg(F.max("end")).first()[0] == 100_000 * 5 - 2
    assert time.time() - start < 30


def plain_ranks(edges, nodes, damping, steps):
    rank = dict.fromkeys(nodes, 1 / len(nodes))
    near = collections.defaultdict(set)
    for a, b in edges:
        if a != b:
            near[a].add(b)
            near[b].add(a)
    for _ in range(steps):
        lost = sum(r for v, r in rank.items() if not near[v])
        rank = {v: (1 - damping) / len(nodes) + damping * (lost / len(nodes) + sum(rank[u] / len(near[u]) for u in near[v])) for v in nodes}
    return rank


def test_ranks_until_they_stand_still(spark):
    edges = [(1, 2), (2, 3), (3, 1), (3, 4), (4, 3), (5, 5)]
    df = spark.createDataFrame(edges, "src long, dst long")
    nodes = spark.createDataFrame([(k,) for k in range(1, 8)], "node long")
    found = {r.node: r.rank for r in graph.pagerank(df, 0.8, 200, 1e-9, nodes).collect()}
    want = plain_ranks(edges, range(1, 8), 0.8, 200)
    assert found == pytest.approx(want, abs=1e-8) and sum(found.values()) == pytest.approx(1)
    assert {r.node: r.rank for r in graph.pagerank(df, 0.8, 2, 10.0, nodes).collect()} == pytest.approx(plain_ranks(edges, range(1, 8), 0.8, 1))
    assert not graph.pagerank(df.limit(0), 0.8, 3).collect()


def test_pairs_by_rank(spark):
    ranks = [*range(300), 10**17 + 7, (3_000_000_000 * 2_999_999_999) // 2 - 1, (3_000_000_000 * 2_999_999_999) // 2]
    rows = spark.createDataFrame([(r,) for r in ranks], "r long").select("r", *graph.pair_of(F.col("r"))).collect()
    assert all(0 <= x.low < x.high and x.high * (x.high - 1) // 2 + x.low == x.r for x in rows)
    for size in (1, 2, 3, 97):
        assert sorted(r.p for r in spark.range(size).select(permuted(F.col("id"), size, 3).alias("p")).collect()) == list(range(size))


def test_negative_samples(spark):
    nodes = spark.createDataFrame([(k * 10,) for k in range(12)], "node long")
    edges = spark.createDataFrame([(0, 10), (10, 0), (20, 110), (30, 30), (0, 999)], "src long, dst long")
    free = {(a * 10, b * 10) for a in range(12) for b in range(a + 1, 12)} - {(0, 10), (20, 110)}
    every = graph.negative_sample(nodes, edges, 1000, 1)
    assert {(r.src, r.dst) for r in every.collect()} == free and every.count() == len(free)
    counts = collections.Counter()
    for seed in range(12):
        some = [(r.src, r.dst) for r in graph.negative_sample(nodes, edges, 16, seed).collect()]
        assert len(set(some)) == 16 and set(some) <= free
        counts.update(some)
    assert len(counts) > 0.9 * len(free) and max(counts.values()) <= 9
    assert not graph.negative_sample(nodes.limit(1), edges, 5, 1).collect()


def test_folds_of_many_payloads(spark):
    import random

    luck = random.Random(2)
    some = lambda *v: luck.choice([None, *v])
    rows = [(k, at, some((some("a", "bb", "cc", "d"), some(1, 2), some([1, 1], [2, 1], [3])))) for k in range(20) for at in range(luck.randrange(1, 14))]
    df = spark.createDataFrame(rows, "k int, at int, v struct<t:string,n:int,l:array<int>>")

    def plain(values):
        out, conflicts = None, set()
        for v in values:
            if out is None or v is None:
                out = v if out is None else out
                continue
            t, n, l = out
            if t is not None and v[0] is not None and t != v[0]:
                conflicts.add("$.t")
            if n is not None and v[1] is not None and n != v[1]:
                conflicts.add("$.n")
            t = v[0] if t is None or v[0] is not None and len(v[0]) > len(t) else t
            n = v[1] if n is None else n
            l = v[2] if l is None else l + [x for x in dict.fromkeys(v[2] or []) if x not in l]
            out = (t, n, l)
        return out, sorted(conflicts)

    for block in (256, 3):
        for r in nested.merged_all(df, ["k"], "at", "v", block).collect():
            value, conflicts = plain([v for k, _, v in rows if k == r.k])
            assert (None if r.v is None else tuple(r.v)) == value and r.conflicts == conflicts


def jobs_of(spark, run):
    spark.sparkContext.setJobGroup(run.__name__, "")
    run()
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(run.__name__))


def test_corpus_jobs_do_not_grow_with_shards(spark, tmp_path):
    rows = spark.createDataFrame([(k, f"t{k}", "train", None) for k in range(60)], "doc_id long, text string, split string, error string").repartition(1)

    def few():
        assert sinks.write_corpus(rows, str(tmp_path / "few"), "doc_id", shard_rows=30) == 2

    def many():
        assert sinks.write_corpus(rows, str(tmp_path / "many"), "doc_id", shard_rows=2) == 30

    assert jobs_of(spark, many) <= jobs_of(spark, few) + 2
    for shard in range(30):
        assert spark.read.parquet(str(tmp_path / "many" / "errors" / f"shard={shard}")).count() == 0
        assert spark.read.parquet(str(tmp_path / "many" / "clean" / "split=validation" / f"shard={shard}")).columns == ["doc_id", "text"]


def test_written_corpus_is_what_was_cleaned(spark, sf):
    from quillmine.functions import hashing

    found = {r.doc_id: r for r in catalogue.QUERIES["written_corpus"](spark, sf).collect()}
    docs = cleaned(spark.read.parquet(f"{sf}/documents.parquet")).withColumn("own", hashing.split_of(F.col("doc_id"), 0.10, 42)).orderBy("doc_id").collect()
    assert len(found) == len(docs)
    for place, d in enumerate(docs):
        r = found[d.doc_id]
        assert r.shard == place // 100 and r.split == ("error" if d.error else d.own) and r.text_hash == d.text_hash and r.error == d.error


def test_trees_are_copied_by_tasks(spark, tmp_path):
    for k in range(20):
        os.makedirs(tmp_path / "tree" / str(k))
        (tmp_path / "tree" / str(k) / "a.json").write_bytes(json.dumps(k).encode())
        (tmp_path / "tree" / str(k) / "result.parquet").write_bytes(b"x")
    (tmp_path / "tree" / "big.bin").write_bytes(bytes(range(256)) * 5000)
    for _ in range(2):  # again does no harm
        assert sinks.copy_tree(spark, f"file://{tmp_path}/tree", f"file://{tmp_path}/copy") == 21
    there = sorted(os.path.relpath(os.path.join(d, f), tmp_path / "copy") for d, _, names in os.walk(tmp_path / "copy") for f in names)
    assert there == sorted(["big.bin", *[f"{k}/a.json" for k in range(20)]])
    assert (tmp_path / "copy" / "big.bin").read_bytes() == (tmp_path / "tree" / "big.bin").read_bytes()


def test_principal_components(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").orderBy("vec_id").collect()
    x = np.array([r.embedding for r in rows], float)
    values, axes = np.linalg.eigh(np.cov(x.T, bias=True))
    _, found, share = graph.principal_components(spark.read.parquet(f"{sf}/embeddings.parquet"), "embedding", 2)
    assert share == pytest.approx(values[::-1][:2] / values.sum(), rel=1e-6)
    assert np.abs((found * axes.T[::-1][:2]).sum(axis=1)) == pytest.approx([1, 1], abs=1e-6)
    plane = {r.vec_id: (r.x, r.y) for r in catalogue.QUERIES["embedding_plane"](spark, sf).collect()}
    for r, v in zip(rows, (x - x.mean(axis=0)) @ found.T):
        assert plane[r.vec_id] == pytest.approx(tuple(v), abs=1e-5)


def test_epochs(spark):
    rows = spark.range(250).select(F.col("id").alias("doc_id"))
    orders = []
    for epoch in (0, 1):
        found = sorted(sampling.shuffled(rows, "doc_id", 3, epoch, 50, 8, 2).collect(), key=lambda r: r.place)
        assert [r.place for r in found] == list(range(250)) and sorted(r.doc_id for r in found) == list(range(250))
        assert all(r.shard == r.doc_id // 50 and r.worker == r.shard % 2 and r.batch == r.doc_id % 50 // 8 for r in found)
        # a worker's shards lie one after the other, and batches in order within them
        assert [k for k, _ in itertools.groupby((r.worker, r.shard) for r in found)] == list(dict.fromkeys((r.worker, r.shard) for r in found))
        assert all(list(b) == sorted(b) for b in ([r.batch for r in found if r.shard == s] for s in range(5)))
        orders.append([r.doc_id for r in found])
    assert orders[0] != orders[1] != sorted(orders[1])


def test_downloads_by_tasks(spark, tmp_path):
    from quillmine.sources import files
    from quillmine.sources.shared import put_file

    (tmp_path / "a.bin").write_bytes(bytes(range(256)) * 9000)
    rows = spark.createDataFrame([(f"file://{tmp_path}/a.bin", "x/a.bin"), (f"file://{tmp_path}/none", "b"), (None, "c")], "url string, name string")
    got = {r["name"]: (r["size"], r["error"] is None) for r in files.download(rows, f"file://{tmp_path}/out", chunk=1000).collect()}
    assert got == {"x/a.bin": (256 * 9000, True), "b": (None, False), "c": (None, False)}
    assert (tmp_path / "out" / "x" / "a.bin").read_bytes() == (tmp_path / "a.bin").read_bytes() and os.listdir(tmp_path / "out") == ["x"]

    def broken():
        yield b"some"
        raise OSError("gone")

    with pytest.raises(OSError):
        put_file(f"{tmp_path}/half", broken())
    assert not [n for n in os.listdir(tmp_path) if n == "half" or n.startswith(".")]


def test_slow_documents_are_given_up(spark):
    from quillmine.functions import rtf

    rows = spark.createDataFrame([(1, b"{\\rtf1 a\\par b}"), (2, None), (3, b"{\\rtf1 " + b"\\b x" * 300_000 + b"}")], "k int, c binary")
    got = {r.k: (r.r.text, r.r.error) for r in rows.select("k", rtf.converted(F.col("c"), 0.0001).alias("r")).collect()}
    assert got[2] == (None, None) and got[3][0] is None and "seconds" in got[3][1]
    assert rows.select("k", rtf.converted(F.col("c"), 60).alias("r")).where("k = 1").first().r.text == "a\nb"


def test_calls_leave_files(spark, tmp_path):
    from quillmine.operators import model

    prompts = spark.createDataFrame([("d/1", "good"), ("d2", "bad")], "document_id string, prompt string")
    said = lambda messages: "{}" if messages[0]["content"].startswith("good") else "no object"
    answers = model.answered(prompts, said, keep_calls=True)
    assert model.answered(prompts, said).columns == ["document_id", "prompt", "answer", "calls", "error"]
    assert sinks.write_files(model.call_artifacts(answers, ["document_id"]), f"file://{tmp_path}/calls") == 3
    read = lambda *parts: json.loads((tmp_path / "calls").joinpath(*parts).read_text())
    assert read("d_1", "call-001.json") == {"call": 1, "error": None, "request": "good", "response": "{}"}
    assert read("d2", "call-002.json")["request"].startswith("bad\n\nThe last answer") and read("d2", "call-001.json")["error"]
    assert model.answered(prompts, said, context_tokens=0, most_new_tokens=9, keep_calls=True).first().attempts == []


def test_answers_are_judged_once(spark):
    from quillmine.functions import nested

    cases = {'{"k": 1}': (1, None), ' ```json\n{"k": 2}\n``` ': (2, None), '{"k": 3,}': (3, None), '{"k": 4': (None, "not JSON or cut off"), '{k}': (None, "broken object"), "[1]": (None, "not an object"), "": (None, "not JSON or cut off"), '{"k": 5} {"k": 6}': (None, "broken object"), "```{": (None, "not JSON or cut off"), "5": (None, "not an object")}
    rows = spark.createDataFrame([(k,) for k in cases], "t string")
    got = {r.t: (r.p.value.k if r.p.value else None, r.p.error) for r in rows.select("t", nested.parsed_object(F.col("t"), "k long").alias("p")).collect()}
    assert got == cases
    one = rows.select(nested.parsed_object(F.col("t"), "k long", lambda t: "{").alias("p"), "t").where("t = '{k}'").first()
    assert one.p.error is not None
