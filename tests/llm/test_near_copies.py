"""The near-copy operator held against the similarity of all pairs."""

import random
import re

import numpy as np
import pytest

from quillmine.llm import near_copies, simhash

from .helpers import documents, empty_documents, odd_documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def plain_classes(items, least=0.8):
    """items: (doc_id, text) -> class of each place."""
    sets, root = [shingles(t) for _, t in items], list(range(len(items)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if min(len(a), len(b)) >= least * max(len(a), len(b)) and len(a & b) >= least * len(a | b):
                root[find(i)] = find(j)
    return [find(k) for k in range(len(items))]


def survivors(items):
    first = {}
    for (doc_id, _), c in zip(items, plain_classes(items)):
        key = (doc_id is None, doc_id or 0)
        first[c] = min(first.get(c, key), key)
    return sorted(None if none else d for none, d in first.values()) if not any(n for n, _ in first.values()) else sorted((d for n, d in first.values() if not n)) + [None] * sum(n for n, _ in first.values())


def edited(text, share, r):
    words = text.split()
    for k in range(len(words)):
        if r.random() < share:
            words[k] = "w%d" % r.randrange(10**6)
    return " ".join(words)


def ids(df):
    got = [r.doc_id for r in df.select("doc_id").collect()]
    return sorted(x for x in got if x is not None) + [None] * got.count(None)


def test_one_of_each_class_by_brute_force(spark, sf):
    for docs in (odd_documents(spark), documents(spark, sf)):
        kept = near_copies.deduplicated(docs)
        assert kept.columns == docs.columns
        assert ids(kept) == survivors([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert near_copies.deduplicated(empty_documents(spark)).count() == 0


def test_rows_that_stay_are_whole(spark, sf):
    docs = documents(spark, sf)
    before = {r.doc_id: tuple(r) for r in docs.collect()}
    assert all(before[r.doc_id] == tuple(r) for r in near_copies.deduplicated(docs).collect())


def test_clashing_and_dotted_names_and_repeated_rows(spark):
    names = "doc_id long, text string, `a.b` string, copy string, node string, root string, `class` string, first string, sketch string, m map<string,int>"
    rows = [(k, f"some words that only text {k} has here", "x", "c", "n", "r", "k", "f", "s", {"a": k}) for k in range(5)]
    docs = spark.createDataFrame([*rows, rows[0], rows[0], rows[3]], names)
    got = near_copies.deduplicated(docs)
    assert got.columns == docs.columns and sorted(got.collect()) == sorted(spark.createDataFrame(rows, names).collect())


def test_edited_groups_in_many_chunks(spark, monkeypatch):
    """Hundreds of copies around one text, at similarities on both sides of 0.8, with chunks of few texts."""
    monkeypatch.setattr(simhash, "BLOCK", 32)
    monkeypatch.setattr(near_copies, "TEXTS", 16)
    r = random.Random(3)
    items = []
    for g in range(3):
        base = " ".join("v%d" % r.randrange(400) for _ in range(120))
        items += [(len(items) + k, edited(base, r.choice([0, 0.005, 0.01, 0.02, 0.03]), r)) for k in range(120)]
    items += [(len(items) + k, " ".join("u%d" % r.randrange(400) for _ in range(60))) for k in range(40)]
    got = near_copies.deduplicated(spark.createDataFrame(items, "doc_id long, text string"))
    assert ids(got) == survivors(items)


@pytest.mark.parametrize("share", [0.8, 0.85, 0.9])
def test_candidates_find_nearly_all_similar_pairs(share):
    """Texts at and above the least similarity: a shared band and a distance within the radius."""
    r = np.random.default_rng(int(share * 100))
    found = 0
    for _ in range(300):
        n = 200
        common = round(2 * share * n / (1 + share))
        a = r.integers(0, 1 << 63, 2 * n - common, dtype=np.uint64) * np.uint64(2)
        x, y = near_copies.sketch(a[:n]), near_copies.sketch(a[n - common :])
        found += bool(set(x[1]) & set(y[1])) and bin((x[0] ^ y[0]) & (1 << 64) - 1).count("1") <= near_copies.RADIUS
    assert found >= 298


def test_shingles_by_brute_force():
    for text in (None, "", "One two", "a b c d e", "A b\tc d e f g a b c d e f", "é ü ñ ß å æ"):
        assert len(set(near_copies.shingle_hashes(text).tolist())) == len(shingles(text))
