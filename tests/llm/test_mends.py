"""Hot keys, unseen spellings and long white space."""

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillmine.llm import fingerprints, language, mixing, packing, pii, simhash, toxicity
from quillmine.llm.common import in_fold
from tests.llm.helpers import rows_of


def test_no_language_is_lost(spark):
    """Every language's rows repeat one id; a rare language's too, beside a common one; texts without a letter don't count."""
    luck = random.Random(1)
    rows = [(k, f"l{k:02d}", f"{luck.random()} some text {k}") for k in range(60) for _ in range(40)]
    rows += [(7, "xx", f"text {k}") for k in range(300)] + [(1000 + k, "en", f"word {k}") for k in range(20)] + [(2000 + k, "yy", "1 2 3") for k in range(3000)] + [(7, "yy", "one letter")]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(3)
    want = {r.lang for r in docs.where(~in_fold(F.col("doc_id"), 4, 2) & F.col("text").rlike("[a-z]")).select("lang").distinct().collect()}
    for most in (2, 250):
        got = language.training_windows(docs, most)
        assert {r.lang for r in got.collect()} == want and len(want) > 46
        assert got.groupBy("lang").count().agg(F.max("count")).first()[0] <= most * language.WINDOWS_OF_DOC


def test_equal_rows_are_one_document_to_learn_from(spark):
    docs = spark.createDataFrame([(11, "aa", "the same text")] * 500 + [(12, "aa", None)], "doc_id long, lang string, text string")
    assert language.training_windows(docs).groupBy("lang").count().where("lang = 'aa'").first()["count"] == language.WINDOWS_OF_DOC


def test_seventy_languages_are_told_apart():
    luck = np.random.default_rng(5)
    letters = [luck.choice(np.frombuffer(b"abcdefghijklmnopqrstuvwxyz", np.uint8), 5, replace=False) for _ in range(70)]
    made = lambda k: b" ".join(bytes(luck.choice(letters[k], 6)) for _ in range(9))[: language.WINDOW]
    p = language.train_network([(made(k), k) for k in range(70) for _ in range(20)], 70, steps=300)
    model = language.Model([f"l{k:02d}" for k in range(70)], p)
    texts, want = zip(*[((made(k) + b" " + made(k) + b" " + made(k)).decode(), f"l{k:02d}") for k in range(70) for _ in range(4)])
    assert np.mean([got == w for (got, _), w in zip(model.predict(list(texts)), want)]) > 0.8


def test_a_crowded_key_of_like_nodes_is_dealt_in_proportion(spark, monkeypatch):
    """Fingerprints about one centre, all in one bucket: what tasks compare grows as their number does, and links stay whole."""
    monkeypatch.setattr(simhash, "BLOCK", 64)
    dealt, plain = {}, simhash.in_groups

    def counted(rows):
        dealt["n"] = dealt.get("n", 0) + rows.count()
        return plain(rows)

    monkeypatch.setattr(simhash, "in_groups", counted)
    luck = np.random.default_rng(2)
    counts = []
    for n in (1000, 4000):
        values = {0}
        while len(values) < n - 4:
            values.add(int(sum(1 << int(b) for b in luck.choice(40, luck.integers(1, 7), replace=False))))
        values |= {(1 << 60) - 1, (1 << 59) - 1, (1 << 50) - 3, (1 << 45) - 1}
        rows = spark.createDataFrame([(v, v, 1) for v in values], "node long, fingerprint long, key long")
        dealt.clear()
        links = simhash.bucket_links(rows, 8, True)
        roots = {r.node: r.root for r in simhash.components(links).collect()}
        counts.append(dealt["n"])
        a, b = simhash.near_pairs(np.array(sorted(values), np.uint64), np.array(sorted(values), np.uint64), 8)
        want = simhash.spanning(len(values), a, b)
        order = sorted(values)
        assert [roots.get(v, v) for v in order] == [order[k] for k in want]
    assert counts[1] < 6 * max(counts[0], 1)


def test_equal_rows_fill_all_buckets_of_the_mix(spark, monkeypatch):
    rows = [(5, "one two three", "a")] * 3000 + [(k, f"w{k} x", "a") for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    whole = mixing.mixture(docs)
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 500)
    cut = mixing.mixture(docs)
    for found in (whole, cut):
        assert found.count() == len(rows)
        taken = found.agg(F.sum("taken")).first()[0]
        assert abs(taken - found.first().target) < 200 and found.where("taken > 2 * size").count() == 0
    seen = {}
    plain = mixing.stored
    monkeypatch.setattr(mixing, "stored", lambda df, name: seen.setdefault(name, plain(df, name)))
    mixing.mixture(docs)
    sizes = seen["sizes"]
    often = sizes.groupBy("row_key", "doc_id").count().where("count > 125")
    assert often.count() == 1 and sizes.select("spread").distinct().count() == len(rows)


def test_equal_rows_are_spread_among_fingerprints(spark, monkeypatch):
    rows = [(5, "One sentence here. Another one there.")] * 400 + [(None, "No id.")] * 150 + [(k, f"Text {k}. More of {k}.") for k in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = rows_of(fingerprints.compared(docs))
    monkeypatch.setattr(fingerprints, "BUCKET_ROWS", 50)
    assert rows_of(fingerprints.compared(docs)) == want


@pytest.mark.parametrize("left_out", [0, 1, 2])
def test_spellings_that_training_has_not_seen(spark, left_out):
    luck = random.Random(left_out)
    number = lambda n: "".join(luck.choice("0123456789") for _ in range(n))

    def card():
        body = number(15)
        return next(x for x in (f"{body}{d}" for d in range(10)) if pii.luhn(x))

    def texts(n):
        for k in range(n):
            c = card()
            values = {"email": f"ann{k}@mail{k % 7}.example.org", "ip": ".".join(str(luck.randrange(256)) for _ in range(4)), "card": " ".join(c[j : j + 4] for j in range(0, 16, 4)), "phone": f"+44 {number(2)} {number(4)} {number(4)}"}
            kind = pii.KINDS[k % 4]
            yield kind, values[kind], f"Some words here {luck.choice(['tell of', 'about', 'with'])} {values[kind]} and {luck.choice(['more', 'others'])} in {luck.randrange(1900, 2030)}, page {luck.randrange(90)} of {number(5)}.\n"

    rows = []
    for kind, _, text in texts(1200):
        found = pii.examples(text, left_out)
        rows += [(k, tuple(x), y, loose, luck.randrange(pii.FOLDS)) for k, x, y, loose in found]
    model = pii.fit(rows)
    assert set(model.thresholds) == set(pii.KINDS)
    right = dict.fromkeys(pii.KINDS, 0)
    for kind, value, text in texts(200):
        forms = pii.spellings(kind, value)
        written = text.replace(value, forms[left_out])
        start = written.index(forms[left_out])
        right[kind] += any(a < start + len(forms[left_out]) and b > start for _, a, b in model.spans(written))
        base = pii.base_spans(text)
        assert set(base) <= set(model.spans(text))
    # addresses in words, with spaces, are not dared where no such spelling was seen
    assert all(n >= 25 for kind, n in right.items() if (kind, left_out) != ("email", 2)), right  # of 50


def test_overlap_with_a_long_span():
    text = "a" + ".1.2.3.4" * 8 + "@example.org"
    base = pii.base_spans(text)
    long = next(s for s in base if s[0] == "email")
    taken = pii.united(base)
    assert all(pii.overlaps(taken, ("phone", k, k + 2)) for k in range(long[1], long[2] - 2)) and not pii.overlaps(taken, ("ip", long[2], long[2] + 4))
    text = "at 10 . 0 . 0 . 1 or 10[.]0[.]0[.]2"
    assert [text[a:b] for kind, a, b in pii.candidates(text) if kind == "ip"] == ["10[.]0[.]0[.]2", "10 . 0 . 0 . 1"]


def test_long_white_space_takes_time_in_proportion():
    import public_tokenizers
    from tokenizers import Tokenizer

    encode = packing.encoder(packing.VOCABULARY)
    encode("warm")
    text = ("\t" * 32_000 + "x") * 20
    start = time.time()
    ids = encode(text)
    assert time.time() - start < 10
    assert ids == Tokenizer.from_file(public_tokenizers.path(f"{packing.VOCABULARY}.json")).encode(text, add_special_tokens=False).ids


def test_long_runs_are_seen_wherever_they_lie():
    luck = random.Random(3)
    for _ in range(400):
        text = "x y" * luck.randrange(300) + luck.choice(" \t\n\u2003") * luck.randrange(packing.LONG_RUN - 3, packing.LONG_RUN + 3) + "z  " * luck.randrange(300)
        assert packing.has_long_run(text) == (packing._LONG_RUN.search(text) is not None)
    assert not packing.has_long_run("") and packing.has_long_run(" " * packing.LONG_RUN) and not packing.has_long_run(" " * (packing.LONG_RUN - 1))


def test_all_sure_grams_are_features():
    docs = np.array([[0.0] * 30_000, [50.0] * 30_000])
    slots = np.arange(30_000)
    assert len(toxicity.chosen_slots(slots, docs, [100, 100])[0]) == 30_000 and len(toxicity.chosen_slots(slots, docs, [100, 100], 7)[0]) == 7
