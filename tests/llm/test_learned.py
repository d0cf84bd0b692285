"""The learned operators: plain versions of their parts, held-out quality, and odd rows."""

import collections
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillmine.llm import boosting, language, pii, suffix_tree, toxicity, urls

from .helpers import documents, empty_documents, odd_documents

BIG = "/root/testdata/sf0.01"


def crc(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


# ---- toxicity


def test_ngrams_by_plain_loops():
    def plain(text):
        data = b" " + b" ".join(text.lower().encode().split()) + b" "
        found = []
        for size in toxicity.SIZES:
            for i in range(len(data) - size + 1):
                code = data[i]
                for b in data[i + 1 : i + size]:
                    code = (code * 0x9E3779B97F4A7C15 + b) % 2**64
                found.append(((code ^ size) * 0xD6E8FEB86659FD93) % 2**64 >> (64 - toxicity.TABLE_BITS))
        return collections.Counter(found)

    for text in ("Ab c", "", "réeux ÉÈ\n\n x y z" * 3):
        slots, counts, length = toxicity.gram_counts(text)
        assert dict(zip(slots.tolist(), counts.tolist())) == dict(plain(text))


def test_ngrams_do_not_depend_on_chunks(monkeypatch):
    text = "some words that are cut at odd places " * 9
    whole = toxicity.gram_counts(text)
    monkeypatch.setattr(toxicity, "CHUNK", 11)
    assert all(np.array_equal(a, b) for a, b in zip(whole, toxicity.gram_counts(text)))


def test_features_by_plain_counts(spark):
    """Slots, ratios and values of a fit, by plain code over the same texts."""
    r = np.random.default_rng(9)
    rows = [(k, " ".join(r.choice(["bad", "worse", "vile"] if k % 3 == 0 and i % 4 == 0 else ["tree", "road", "house", "sky"]) for i in range(30)), int(k % 3 == 0)) for k in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, label int").repartition(3)
    plain = [collections.Counter(), collections.Counter()]
    for _, text, label in rows:
        plain[label].update(set(toxicity.gram_counts(text)[0].tolist()))
    got = {x.slot: (x.n0, x.n1) for x in toxicity.slot_counts(df).collect()}
    assert got == {s: (plain[0][s], plain[1][s]) for s in {*plain[0], *plain[1]}}
    slots = np.array(sorted(got))
    chosen, ratio = toxicity.chosen_slots(slots, np.array([[got[s][k] for s in slots.tolist()] for k in (0, 1)], float), [40, 20])
    for s, x in zip(chosen.tolist(), ratio.tolist()):
        n0, n1 = got[s]
        assert x == pytest.approx(math.log((n1 + 0.5) / 21) - math.log((n0 + 0.5) / 41)) and abs(x) / math.sqrt(1 / (n1 + 0.5) + 1 / (n0 + 0.5)) >= toxicity.LEAST_Z and n0 + n1 >= toxicity.LEAST_DOCS
    for x in toxicity.sparse_rows(df, chosen, ratio).collect():
        counts = dict(zip(*(v.tolist() for v in toxicity.gram_counts(rows[int(x.key)][1])[:2])))
        assert np.frombuffer(x.places, np.int32).tolist() == [k for k, s in enumerate(chosen.tolist()) if s in counts]
        assert np.frombuffer(x["values"], np.float32).tolist() == pytest.approx([math.log1p(counts[s]) * ratio[k] for k, s in enumerate(chosen.tolist()) if s in counts], rel=1e-5)
    model = toxicity.fit(df)
    assert all((model.score(text) >= 0.5) == label for _, text, label in rows)


def test_toxicity_on_held_out_rows(spark):
    docs, labels = documents(spark, BIG), spark.read.parquet(f"{BIG}/labels.parquet")
    got = {r.doc_id: r for r in toxicity.scored(docs, labels).collect()}
    assert len(got) == docs.count() and all(r.held_out == (crc(d, 5) == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for d, r in got.items())
    toxic = {r.doc_id: r.toxic for r in labels.collect()}
    held = [(toxic[d], got[d].predicted) for d in toxic if crc(d, 5) == 0]
    wrong_clean = sum(p for t, p in held if t == 0) / sum(t == 0 for t, _ in held)
    found = sum(p for t, p in held if t) / sum(t for t, _ in held)
    assert found >= 0.7 and wrong_clean <= 0.05
    accepted = toxicity.accepted(docs, labels)
    assert accepted.columns == docs.columns and {r.doc_id for r in accepted.collect()} == {d for d, r in got.items() if not r.predicted}


def test_toxicity_odd_rows(spark):
    labels = spark.createDataFrame([(3, 1), (4, 0), (None, 1), (5, None), (6, 7), (3, 1)], "doc_id long, toxic int")
    assert toxicity.scored(odd_documents(spark), labels).count() == odd_documents(spark).count()
    assert toxicity.scored(odd_documents(spark), labels.limit(0)).where("predicted = 1").count() == 0
    assert toxicity.scored(empty_documents(spark), labels).count() == 0


# ---- language


def test_slopes_by_differences():
    r = np.random.default_rng(2)
    p = language.start(3)
    batch, mask, labels = r.integers(97, 103, (4, 6)).astype(np.uint8), np.ones((4, 6), bool), np.array([0, 1, 2, 1])
    mask[1, 4:] = False
    mask[3, 2:] = False
    _, slopes = language.loss_and_slopes(p, batch, mask, labels)
    for name in p:
        flat, slope = p[name].reshape(-1), slopes[name].reshape(-1)
        for k in np.argsort(-np.abs(slope))[:5]:
            old = flat[k]
            flat[k] = old + 1e-5
            up, _ = language.loss_and_slopes(p, batch, mask, labels)
            flat[k] = old - 1e-5
            down, _ = language.loss_and_slopes(p, batch, mask, labels)
            flat[k] = old
            assert slope[k] == pytest.approx((up - down) / 2e-5, rel=1e-4, abs=1e-9)


def test_reading_by_plain_loops():
    r = np.random.default_rng(3)
    model = language.Model(["a", "b", "c"], language.start(3))
    p, h = language.start(3), language.HIDDEN
    sig = lambda x: 1 / (1 + math.exp(-x))
    data = bytes(r.integers(97, 120, language.WINDOW + 9).astype(np.uint8))

    def plain(piece):
        states = []
        for d in (0, 1):
            state, out = [0.0] * h, [None] * len(piece)
            for t in range(len(piece)) if d == 0 else reversed(range(len(piece))):
                x = p["in"][d][piece[t]]
                g = [sig(x[k] + sum(state[i] * p["gates"][d][i][k] for i in range(h))) for k in range(2 * h)]
                inner = [sum(state[i] * p["new"][d][i][k] for i in range(h)) for k in range(h)]
                new = [math.tanh(x[2 * h + k] + g[h + k] * inner[k]) for k in range(h)]
                state = [(1 - g[k]) * new[k] + g[k] * state[k] for k in range(h)]
                out[t] = state
            states.append(out)
        odds = []
        for t in range(len(piece)):
            z = [math.exp(sum(states[d][t][i] * p["out"][d][i][c] for d in (0, 1) for i in range(h)) + p["bias"][c]) for c in range(3)]
            odds.append([v / sum(z) for v in z])
        return odds

    expected = np.mean(plain(data[: language.WINDOW]) + plain(data[language.WINDOW :]), axis=0)
    assert model.pooled([data.decode(), data.decode()])[1] == pytest.approx(expected, rel=1e-4)


def test_language_on_held_out_rows(spark):
    docs = documents(spark, BIG)
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    got = {r.doc_id: r for r in language.identified(docs).collect()}
    held = [d for d in truth if crc(d, 4) == 2]
    assert all(got[d].held_out for d in held) and sum(r.held_out for r in got.values()) == len(held)
    assert sum(got[d].lang_pred == truth[d] for d in held) / len(held) > 0.95
    assert all(0 <= r.score <= 1 for r in got.values())


def test_language_odd_rows(spark):
    got = language.identified(odd_documents(spark).withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "xx").otherwise("yy"))).collect()
    assert len(got) == odd_documents(spark).count()
    assert {r.lang_pred for r in got if r.doc_id in (0, 1, 2)} == {"und"} and {r.lang_pred for r in got} <= {"und", "xx", "yy"}
    assert {r.lang_pred for r in language.identified(odd_documents(spark).withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert language.identified(empty_documents(spark)).count() == 0


def test_marks_that_are_no_letters(spark):
    docs = spark.createDataFrame([(k, "words of one kind", "aa") for k in range(20)] + [(k, "слова иного рода", "bb") for k in range(20, 40)] + [(50, "²", None), (51, "½ 12", None), (52, "Ⅷ", None), (53, "12 — «»", None), (54, "ª", None)], "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang_pred for r in language.identified(docs).collect()}
    assert [got[k] for k in (50, 51, 52, 53)] == ["und"] * 4 and got[54] != "und"
    assert (got[19], got[20]) == ("aa", "bb")


def test_only_bytes_of_letters_count():
    for text in ("a–b é½", "日本 x²", "", "😀ß", "ab1"):
        data = text.encode()
        plain = [c.isalpha() for c in text for _ in c.encode()]
        assert language.letter_bytes(text, data).tolist() == plain


def test_rare_languages_are_learned_beside_seventy(spark):
    r = np.random.default_rng(8)
    rows, n = [], 0
    for k in range(70):
        sign = chr(0x4E00 + 40 * k)
        for _ in range(9 if k else 3):
            rows.append((n, "".join(chr(ord(sign) + i) for i in r.integers(0, 8, 30)), f"l{k:02d}"))
            n += 1
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {x.lang for x in language.training_windows(docs).collect()} == {f"l{k:02d}" for k in range(70)}
    counts = collections.Counter(x.lang for x in language.training_windows(docs, 2).collect())
    assert set(counts.values()) == {2 * language.WINDOWS_OF_DOC}


# ---- personal data

EMAIL, IP, CARD, PHONE = (re.compile(p) for p in (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"))


def plain_spans(text):
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    tests = (
        ("email", EMAIL, lambda m: True), ("ip", IP, lambda m: all(int(x) <= 255 for x in m.group().split("."))),
        ("card", CARD, lambda m: 13 <= len(digits(m)) <= 19 and pii.luhn(digits(m))), ("phone", PHONE, lambda m: 9 <= len(digits(m)) <= 15),
    )
    return [(kind, *m.span()) for kind, pattern, holds in tests for m in pattern.finditer(text) if holds(m)]


def test_pattern_spans_by_the_patterns_themselves(spark, sf):
    texts = [r.text for r in documents(spark, BIG).select("text").collect()]
    r = np.random.default_rng(4)
    for alphabet in ("ab@.-1 ", "0123 .-+()", "1.2.3", "@@a.b", "+1 23-45"):
        texts += ["".join(r.choice(list(alphabet), r.integers(0, 60))) for _ in range(400)]
    texts += ["x 4111 1111 1111 1111 y", "256.1.1.1 1.2.3.4.5.6.7.8", "a@b.c@d.e", "é+49 (30) 1234-567 日 x@y.zz"]
    for text in texts:
        assert pii.base_spans(text) == plain_spans(text)


def test_patterns_on_very_long_runs():
    for text in ("a" * 2_000_000, "1" * 300_000, "a@" * 200_000, "." * 500_000, "+1" * 200_000, "1." * 200_000):
        pii.base_spans(text)


def test_looser_spellings_are_found_and_clean_text_is_left(spark):
    docs = documents(spark, BIG)
    model = pii.train(docs)
    for text in ("write to jane.doe (at) example (dot) com now", "mail bob[at]mail[dot]example[dot]org today"):
        assert [k for k, *_ in model.spans(text)] == ["email"], text
    assert model.spans("plain words at noon, version 1.2 of 2024 and 12 items") == []
    rows = pii.personal_data(docs, model).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    added = 0
    for r in rows:
        spans, base = [tuple(s) for s in r.spans], plain_spans(texts[r.doc_id])
        assert set(base) <= set(spans)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x for x, *_ in base) for k in pii.KINDS]
        added += len(spans) - len(base)
    assert added <= 0.05 * sum(len(r.spans) for r in rows)


def plain_numbers(text):
    groups = [m.span() for m in re.finditer("[0-9]+", text)]
    found = set()
    for i in range(len(groups)):
        start = groups[i][0]
        signed = start - 1 if text[max(0, start - 1) : start] in ("+", "(") else start - 2 if text[max(0, start - 2) : start] == "+(" else start
        for j in range(i, len(groups)):
            between = [text[groups[k][1] : groups[k + 1][0]] for k in range(i, j)]
            end, n = groups[j][1], sum(b - a for a, b in groups[i : j + 1])
            if n > 19 or end - start > 48 or not all(re.fullmatch(r"[\x20().\-/‐-–]{1,3}", x) for x in between):
                break
            if 9 <= n <= 15 or n in (7, 8) and signed < start:
                found.add(("phone", signed, end))
            if n >= 13:
                found.add(("card", start, end))
            if j - i == 3 and text[start:end].count(".") == 3:
                found.add(("ip", start, end))
    return found


def test_candidates_by_plain_code():
    r = np.random.default_rng(12)
    texts = ["030 1234567 040 7654321", "(030) 1234-567 / 12.05.2024", "+(1) 23 45 67 89", "1.2.3.4.5 6", "a4111–1111/1111.1111b"]
    texts += ["".join(r.choice(list("0123456 .-(+/x"), r.integers(5, 90))) for _ in range(300)]
    for text in texts:
        got = [c for c in pii.number_candidates(text)]
        assert len(got) == len(set(got)) and set(got) == {c for c in plain_numbers(text) if any(m.end() - m.start() >= 7 and m.start() <= c[2] - 1 < m.end() for m in pii._RUN.finditer(text))}


def test_spans_of_the_query_by_plain_choice(spark, tmp_path):
    """Loose spans planted in a table come out of the query, which takes each text's best candidates that overlap nothing."""
    from quillmine.llm import queries

    docs = documents(spark, BIG)
    planted = {10_000_001: "please write to jane.doe (at) example (dot) com before noon", 10_000_002: "mail bob[at]mail[dot]example[dot]org today", 10_000_003: "the card 4845/1681/1440/7329 was used"}
    extra = spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in planted.items()], docs.select("doc_id", "text", "lang", "source", "n_chars").schema)
    docs.unionByName(extra).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r.spans for r in queries.op7_personal_data(spark, str(tmp_path)).collect()}
    for k, t in planted.items():
        kind, a, b = got[k].split(":")
        assert (kind, t[int(a) : int(b)]) in {("email", "jane.doe (at) example (dot) com"), ("email", "bob[at]mail[dot]example[dot]org"), ("card", "4845/1681/1440/7329")}
    model = pii.train(spark.read.parquet(str(tmp_path / "documents.parquet")))
    for doc_id, text in [*planted.items(), *((r.doc_id, r.text) for r in docs.limit(300).collect())]:
        kept = plain_spans(text or "")
        scored = sorted(((-model.forest.probability(np.array([pii.features(text, *c)]))[0], a - b, k, (kind, a, b)) for k, c in enumerate(pii.candidates(text)) for kind, a, b in [c]), key=lambda x: x[:3])
        for p, _, _, (kind, a, b) in scored:
            if -p >= model.thresholds.get(kind, 2) and not any(x < b and a < y for _, x, y in kept):
                kept.append((kind, a, b))
        assert got[doc_id] == ",".join(f"{kind}:{a}:{b}" for kind, a, b in sorted(kept, key=lambda s: (pii.KINDS.index(s[0]), s[1], s[2])))


def test_loose_spans_of_unseen_texts_are_recalled(spark):
    """By kind, on texts that neither trees nor thresholds have seen."""
    docs = documents(spark, "/root/testdata/sf0.1")
    model = pii.train(docs.where("doc_id % 2 = 0"))
    hits = collections.defaultdict(list)
    for r in docs.where("doc_id % 2 = 1 and text rlike '[0-9@]'").select("text").collect():
        for kind, a, b in pii.base_spans(r.text):
            for around, k, x, y in pii.loosened(r.text, kind, a, b, len(r.text)):
                hits[k].append((k, x, y) in model.spans(around))
    assert all(sum(v) >= 0.85 * len(v) for v in hits.values()) and set(hits) == set(pii.KINDS), {k: (sum(v), len(v)) for k, v in hits.items()}


def test_redaction(spark):
    out = pii.without_personal_data(odd_documents(spark).union(spark.createDataFrame([(99, "é x@y.zz 1.2.3.4!", None, None, 5, *[None] * 9)], odd_documents(spark).schema)))
    assert out.columns == odd_documents(spark).columns
    got = {r.doc_id: r for r in out.collect() if r.doc_id is not None}
    assert got[99].text == "é [EMAIL] [IP]!" and got[99].n_chars == len(got[99].text) and got[0].text is None
    assert pii.personal_data(empty_documents(spark)).count() == 0
    assert pii.redacted("abcdef", [("email", 1, 4), ("card", 2, 5)]) == "a[EMAIL]f"


# ---- URLs


def test_rules_and_hosts_by_plain_code(spark):
    odd = [None, "", "no scheme/here", "http://", "HTTPS://A.Example.COM/en/7?x#y", "x://y://z/a", "http://com/en/", "http://icom/en/x", "http://a.org?q/es/", "http://a.org/es/1#f", "http://example.net/de/81", "http://b.net/de", "ftp://É.COM/en/", "http://u:p@a.com:80/en/", "http://a.com/en/\nx"]
    pages = spark.createDataFrame([(k, u, "h", "c") for k, u in enumerate(odd)] + [(None, odd[4], None, None)], "page_id long, url string, host string, rule string")
    pages = pages.select("page_id", "url").unionByName(spark.read.parquet(f"{BIG}/pages.parquet").select((F.col("page_id") + 1000).alias("page_id"), "url"))
    urls_of = collections.defaultdict(list)
    for r in pages.collect():
        urls_of[r.page_id].append(r.url)
    got = urls.judged(pages).collect()
    assert len(got) == sum(map(len, urls_of.values()))
    for r in got:
        url = urls_of[r.page_id][0]
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        host = re.match(r"[^/?#]*", rest).group()
        path = re.match(r"[^?#]*", rest[len(host) :]).group()
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
        fits = [(v, t) for v, t in urls.RULES if (host == t.split("/")[0] or host.endswith("." + t.split("/")[0])) and path.startswith(t[t.index("/") :])]
        best = max(fits, key=lambda x: len(x[1]), default=(None, None))
        assert (r.host, r.path, r.rule) == (host, path, best[1])
        assert r.verdict == best[0] if best[0] else r.verdict in ("allow", "block")
    assert urls.judged(pages.limit(0)).count() == 0


def test_lexical_features_by_plain_code(spark):
    odd = [None, "", "http://", "https://a-b.Example.com/x/y.html?p=1&q=&r#f", "ftp://1.2.3.4/", "http://h/?", "http://h?a=b", "x://é.net/ñ/7//", "https://h/p#x?y=1&z"]
    rows = spark.createDataFrame([(k, u) for k, u in enumerate(odd)], "page_id long, url string")
    rows = rows.unionByName(spark.read.parquet(f"{BIG}/pages.parquet").select((F.col("page_id") + 1000).alias("page_id"), "url"))
    rows = rows.withColumn("host", urls.host_of(F.col("url"))).withColumn("path", urls.path_of(F.col("url")))
    of = urls.lexical(F.col("url"), F.col("host"), F.col("path"))
    opened = urls.suffixes(F.col("host"), F.col("path"))

    def bits(text):
        counts = collections.Counter(text)
        return -sum(n / len(text) * math.log2(n / len(text)) for n in counts.values())

    for r in rows.select("url", "host", "path", *[c.alias(f"f_{n}") for n, c in (of | opened).items()]).collect():
        url, host, path = r.url or "", r.host, r.path
        query = re.match(r"[^?#]*\?([^#]*)", url)
        query = query.group(1) if query else ""
        plain = {
            "url_length": len(url), "host_length": len(host), "path_length": len(path), "host_parts": host.count("."), "depth": path.count("/"), "hyphens": host.count("-"),
            "digit_ratio": len(re.findall("[0-9]", url)) / max(1, len(url)), "path_digits": len(re.findall("[0-9]", path)), "entropy": bits(url), "host_entropy": bits(host),
            "parameters": query.count("&") + 1 if query else 0, "query_length": len(query), "fragment": "#" in url, "secure": url.startswith("https://"),
            "page_suffix": 2 if path.endswith("/") else len(re.findall(r"\.[a-z]+$", path)),
        }
        assert {n: r[f"f_{n}"] for n in of} == pytest.approx({n: float(v) for n, v in plain.items()}), url
        top = path.split("/")[1] if path.startswith("/") else ""
        assert [r.f_suffix, r.f_site, r.f_top] == [host.split(".")[-1], ".".join(host.split(".")[-2:]), top], url


def test_trees_judge_hosts_without_rules_by_their_form(spark):
    rng = np.random.default_rng(8)
    digits = lambda n: "".join(map(str, rng.integers(0, 10, n)))
    long = lambda host: f"http://{host}/go/{digits(9)}/{digits(7)}?id={digits(12)}&ref={digits(5)}&s={digits(4)}"
    short = lambda host: f"https://{host}/about/{'abcdefghij'[rng.integers(10)] * int(rng.integers(1, 6))}.html"
    rules = tuple(("block", f"pay{k}.test/") for k in range(20)) + tuple(("allow", f"home{k}.test/") for k in range(20))
    ruled = [form(f"{stem}{k}.test") for stem, form in (("pay", long), ("home", short)) for k in range(20) for _ in range(6)]
    free = [(form(f"{stem}{k}.{end}"), says) for form, says in ((long, "block"), (short, "allow")) for stem in ("shop", "news") for end in ("zone", "test") for k in range(10)]
    pages = spark.createDataFrame(list(enumerate(ruled + [url for url, _ in free])), "page_id long, url string")
    got = {r.page_id: r for r in urls.judged(pages, rules).collect()}
    assert all(got[k].rule is not None for k in range(len(ruled))) and all(got[len(ruled) + k].rule is None for k in range(len(free)))
    right = [got[len(ruled) + k].verdict == says for k, (_, says) in enumerate(free)]
    assert sum(right) >= 0.95 * len(right), (sum(right), len(right))


def test_one_verdict_or_none_holds_for_the_rest(spark):
    page = lambda *urls_: spark.createDataFrame([*enumerate(urls_), (0, urls_[0])], "page_id long, url string")
    assert {r.verdict for r in urls.judged(page("http://x.org/a", "http://x.org/b")).collect()} == {"allow"}
    assert {r.verdict for r in urls.judged(page("http://x.org/es/1", "http://x.org/b")).collect()} == {"block"}
    assert {r.verdict for r in urls.judged(page("http://example.com/en/7", "http://x.org/b")).collect()} == {"allow"}


def test_trees_learn_and_read_alike(spark):
    r = np.random.default_rng(6)
    x = r.integers(0, 20, (800, 3)).astype(float)
    y = ((x[:, 0] > 9) ^ (x[:, 1] > 5)).astype(float)
    forest = boosting.train(x, y)
    assert ((forest.probability(x) > 0.5) == y).mean() > 0.97
    df = spark.createDataFrame([tuple(v) for v in x[:100].tolist()], "a double, b double, c double")
    got = [v.m for v in df.select(forest.column([F.col(c) for c in "abc"]).alias("m")).collect()]
    assert got == pytest.approx(forest.margin(x[:100]).tolist())
    assert boosting.cut_for_precision(np.array([0.9, 0.8, 0.7, 0.6]), np.array([1, 1, 0, 1]), 1.0) == 0.8


# ---- suffix tree


def test_tree_by_plain_counts(spark, sf):
    depth, share, divergence = 3, 0.001, 5.0
    docs = documents(spark, sf).limit(60).select("doc_id", "text", "source", "lang")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    train = [t for d, t in rows if crc(d, 10)]
    symbols = lambda t: [suffix_tree.SYMBOL[b] for b in b" ".join(t.encode().lower().split())] + [0]
    grams = [collections.defaultdict(collections.Counter) for _ in range(depth + 1)]
    for t in train:
        s = [0] * depth + symbols(t)
        for i in range(depth, len(s)):
            for d in range(depth + 1):
                grams[d][tuple(s[i - d : i])][s[i]] += 1
    total = sum(grams[0][()].values())
    root = [grams[0][()][x] + 0.1 for x in range(128)]
    states = {(): None}

    def p(context, x):
        value = root[x] / sum(root)
        for d in range(1, len(context) + 1):
            c = context[len(context) - d :]
            if c in states:
                n = grams[d][c]
                value = (n[x] + len(n) * value) / (sum(n.values()) + len(n))
        return value

    for d in range(1, depth + 1):
        new = []
        for c, n in grams[d].items():
            size = sum(n.values())
            if size >= max(2, share * total) and sum(k * math.log(k / size / p(c, x)) for x, k in n.items()) >= divergence:
                new.append(c)
        states |= dict.fromkeys(new)
    got = {r.doc_id: r for r in suffix_tree.scored(docs, depth, share, divergence).collect()}
    words = collections.Counter(w for t in train for w in [*t.encode().lower().split(), None])
    n, v = sum(words.values()), len(words)
    for d, t in rows:
        own = [*t.encode().lower().split(), None]
        s = [0] * depth + symbols(t)
        score = sum(math.log10(p(tuple(s[i - depth : i]), s[i])) - (math.log10(suffix_tree.ESCAPED) if s[i] == suffix_tree.ESCAPE else 0) for i in range(depth, len(s)))
        r = got[d]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (crc(d, 10) == 0, len(own), sum(w in words for w in own), n)
        assert r.base_score == pytest.approx(sum(math.log10((words[w] + 0.1) / (n + 0.1 * (v + 1))) for w in own))
        assert r.score == pytest.approx(score)


def test_codes_do_not_depend_on_parts(monkeypatch):
    texts = [b"abc " * 20, b"", b"x", bytes(range(256))]
    whole = [np.concatenate(v) for v in zip(*suffix_tree.coded(texts))]
    monkeypatch.setattr(suffix_tree, "PART", 7)
    parts = [np.concatenate(v) for v in zip(*suffix_tree.coded(texts))]
    assert all(np.array_equal(a, b) for a, b in zip(whole, parts))


def test_the_tree_beats_the_unigram_score(spark):
    got = suffix_tree.scored(documents(spark, BIG)).where("held_out").agg(F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert got.s > got.b


def test_scores_of_odd_rows(spark):
    got = suffix_tree.scored(odd_documents(spark)).collect()
    assert len(got) == odd_documents(spark).count() and all(r.score < 0 and math.isfinite(r.score) and math.isfinite(r.base_score) for r in got)
    assert suffix_tree.scored(empty_documents(spark)).count() == 0
    assert suffix_tree.scored(odd_documents(spark).where("doc_id is null")).count() == 2


def test_evidence_counts_alike_beside_a_large_corpus(spark):
    """A spelling that occurs 8 times is learned however much else there is: 3e-6 of this table would be 13 occurrences."""
    r = np.random.default_rng(4)
    phrase = "qzxjvkwpq zjqxwkvbq xqjzkwvqp"
    filler = [" ".join(map("".join, r.choice(list("aeioutnrs"), (900, 5)))) for _ in range(800)]
    ids = [k for k in range(2000) if crc(k, 10)]
    held = next(k for k in range(2000) if not crc(k, 10))
    rows = [*zip(ids, [phrase] * 8 + filler), (held, phrase)]
    got = {r.doc_id: r for r in suffix_tree.scored(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[held].held_out and got[held].score / (len(phrase) + 1) > -0.4


def test_letters_of_every_script_are_told_apart(spark):
    possible = {b for c in map(chr, [*range(0xD800), *range(0xE000, 0x10000), *range(0x10000, 0x110000, 64)]) for b in c.lower().encode()} - set(range(9, 14))
    assert len({suffix_tree.SYMBOL[b] for b in possible}) == len(possible)
    held = [k for k in range(200) if not crc(k, 10)][:4]
    texts = ["мова що вчиться з тексту", "文字を学ぶ模型", "“{x} <y> [z]” — $5", "język łączy źdźbło"]
    rows = [(k, texts[k % 4]) for k in range(200) if crc(k, 10)] + [*zip(held, texts)]
    got = {r.doc_id: r.score for r in suffix_tree.scored(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[k] / len(t.encode()) > -0.25 for k, t in zip(held, texts))


def test_counts_too_large_for_a_word_are_summed():
    r = np.random.default_rng(7)
    codes = r.integers(0, 50, 400) << 50
    counts = r.integers(1, 400, 400)
    want = collections.Counter()
    for c, n in zip(codes.tolist(), counts.tolist()):
        want[c] += n
    got = suffix_tree._summed([codes[:100], codes[100:]], [counts[:100], counts[100:]])
    assert [*zip(got[0].tolist(), got[1].tolist())] == sorted(want.items())


def test_normal_texts_and_their_words():
    import pyarrow as pa

    texts = [None, "", " \n", "A b", "\tx\x0b\x0cY \r\n z\x1c\x85  É ", "  ", "one"]
    plain = [" ".join(w.decode() for w in (t or "").encode().lower().split()) for t in texts]
    got = suffix_tree.normal(pa.array(texts))
    assert got.to_pylist() == plain
    words, counts = suffix_tree.words_of(got)
    assert words.to_pylist() == [w for t in plain for w in t.encode().decode().split(" ") if w] and counts.tolist() == [len([w for w in t.split(" ") if w]) for t in plain]
    parts = dict(suffix_tree.word_parts(words, 3))
    assert sorted(np.concatenate(list(parts.values())).tolist()) == list(range(len(words)))
    assert suffix_tree.unpacked_words(suffix_tree.packed_words(words)).to_pylist() == words.to_pylist()


def test_packed_arrays_come_back():
    r = np.random.default_rng(1)
    for values, ordered in ((np.sort(r.integers(0, 1 << 56, 1000)), True), (r.integers(0, 9, 1000), False), (r.random(1000).astype(np.float32), False), (np.empty(0, np.int64), True)):
        assert np.array_equal(suffix_tree.unpacked(suffix_tree.packed(values, ordered), values.dtype, ordered), values)


def test_many_equal_rows_spread_over_chunks(spark, monkeypatch):
    monkeypatch.setattr(suffix_tree, "CHUNK_BYTES", 1000)
    monkeypatch.setattr(suffix_tree, "STRETCH_ROWS", 4)
    monkeypatch.setattr(suffix_tree, "STRETCH_BYTES", 200)
    rows = [(1, "the same words in every row")] * 300 + [(2, "other words"), (10, None)]
    got = suffix_tree.scored(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert collections.Counter(r.doc_id for r in got) == {1: 300, 2: 1, 10: 1} and len({r.score for r in got if r.doc_id == 1}) <= 2
