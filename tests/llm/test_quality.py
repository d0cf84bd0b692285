"""Quality rules: counts by plain loops, the list as expression and as numpy, held-out rates."""

import collections
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillmine.llm import quality, queries
from tests.llm.helpers import documents, empty_documents, odd_documents, rows_of

WORD = re.compile("[^\x20\x09-\x0D]+")


def plain_counts(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    words = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
    often = collections.Counter(windows)
    inside = {k + j for k, w in enumerate(windows) if often[w] > 1 for j in range(8)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(inside)


def made_texts(seed):
    luck = random.Random(seed)
    for _ in range(300):
        words = [luck.choice(["a", "b", "Ünd", "#x", "<|>", "日本", "12", "c"]) for _ in range(luck.randrange(60))]
        if luck.random() < 0.5:
            words += words[luck.randrange(5) : luck.randrange(40)] * luck.randrange(3)
        yield "".join(w + luck.choice([" ", "\n", "\t ", "\x0b", "\xa0", "\n\n"]) for w in words)


def test_counts_by_loops(monkeypatch):
    for chunk in (1 << 20, 7):
        monkeypatch.setattr(quality, "CHUNK", chunk)
        for text in [None, "", " \n", "a " * 9, "\ud800 a", *made_texts(chunk)]:
            assert quality.text_counts(text)[:5] == plain_counts(text)


def test_equal_sums_are_told_apart(monkeypatch):
    """The sieve only sieves: windows that are really there twice count."""
    ids = np.array([*range(8), *range(7), 9, *range(8)])
    windows = [tuple(ids[k : k + 8]) for k in range(len(ids) - 7)]
    inside = {k + j for k, w in enumerate(windows) if windows.count(w) > 1 for j in range(8)}
    assert quality.repeated_words(ids) == len(inside)


def test_list_is_learned_and_reads_alike(spark):
    r = np.random.default_rng(3)
    n = 3000
    x = {"a": r.random(n), "b": r.random(n), "c": r.random(n)}
    bad = (x["a"] > 0.8) | (x["b"] < 0.2) & (x["c"] > 0.5)
    found = quality.learn(x, bad, np.ones(n))
    fresh = {k: r.random(2000) for k in x}
    want = (fresh["a"] > 0.8) | (fresh["b"] < 0.2) & (fresh["c"] > 0.5)
    got = found.first(fresh, 2000)
    assert ((got > 0) == want).mean() > 0.97 and len(found.rules) >= 2
    rows = spark.createDataFrame(list(zip(*[v.tolist() for v in fresh.values()])), "a double, b double, c double")
    read = rows.select(F.coalesce(found.column({k: F.col(k) for k in x}), F.lit(0)).alias("k")).collect()
    assert [r.k for r in read] == got.tolist()
    assert str(found).endswith("else keep")


def test_labels_without_sense_reject_nothing_much():
    r = np.random.default_rng(4)
    x, bad = {"a": r.random(2000), "b": r.random(2000)}, r.random(2000) < 0.1
    assert (quality.learn(x, bad, np.ones(2000)).first(x, 2000) > 0).mean() < 0.02


@pytest.mark.parametrize("given", ["labels", "one", "none"])
def test_odd_documents(spark, given):
    labels = {"labels": [(3, 0), (4, 1), (4, 0), (None, 1), (5, None), (6, 7)], "one": [(8, 1)], "none": []}[given]
    labels = spark.createDataFrame(labels, "doc_id long, quality int")
    docs = odd_documents(spark)
    found = quality.judged(docs, labels)
    want = []
    for d in docs.collect():
        counts = plain_counts(d.text)
        failed = counts[0] < 20 or 100 * counts[4] > 30 * counts[0]
        want.append((d.doc_id, *counts, failed, not failed))
    assert rows_of(found.select("doc_id", *quality.COUNTS[:5], "base_failed", "kept")) == sorted(want, key=repr)
    assert quality.accepted(docs, labels).columns == docs.columns and quality.accepted(docs, labels).count() == sum(w[-1] for w in want)
    assert not quality.judged(empty_documents(spark), labels).collect()


def test_held_out_rates(spark):
    """On the larger table: unseen bad texts are found, unseen good ones stay."""
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    judged = quality.judged(documents(spark, sf).join(labels.select("doc_id"), "doc_id"), labels).where("not base_failed").join(labels, "doc_id")
    rows = [r for r in judged.select("doc_id", "quality", "kept").collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    good, bad = [r.kept for r in rows if r.quality == 1], [r.kept for r in rows if r.quality == 0]
    assert np.mean(good) > 0.99 and np.mean(bad) < 0.1


def test_query_over_the_table(spark, sf):
    found = queries.op11_quality_rules(spark, sf)
    counts = {r.doc_id: plain_counts(r.text) for r in documents(spark, sf).collect()}
    rules = quality.train(documents(spark, sf), spark.read.parquet(f"{sf}/labels.parquet"))
    rows = found.collect()
    assert len(rows) == len(counts)
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts[r.doc_id]
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert r.kept == (not r.base_failed and r.rule is None) and (rules.rules or r.rule is None)
