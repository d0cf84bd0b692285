import hashlib
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from quillmine.llm import fingerprints, mixing, simhash

from .helpers import documents, empty_documents, odd_documents


def plain_fingerprint(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(items):
    """items: (doc_id, fingerprint)."""
    root = list(range(len(items)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(items)):
        for j in range(i):
            if bin(items[i][1] ^ items[j][1]).count("1") <= 3:
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(items):
        r = find(i)
        least[r] = min(x for x in (least.get(r), doc_id) if x is not None) if (least.get(r), doc_id) != (None, None) else None
    return [(doc_id, f"{fp:016x}", least[find(i)]) for i, (doc_id, fp) in enumerate(items)]


def test_near_duplicates_by_brute_force(spark, sf):
    for docs in (odd_documents(spark), documents(spark, sf)):
        items = [(r.doc_id, plain_fingerprint(r.text)) for r in docs.select("doc_id", "text").collect()]
        got = [tuple(r) for r in simhash.near_duplicates(docs).collect()]
        assert Counter(got) == Counter(plain_components(items))
    assert simhash.near_duplicates(empty_documents(spark)).count() == 0


@pytest.mark.parametrize("radius", [0, 1, 2, 3])
def test_bit_slices_by_brute_force(radius):
    r = np.random.default_rng(radius)
    left = r.integers(0, 1 << 63, 150, dtype=np.uint64) * np.uint64(2)
    right = left.copy()
    for k in range(len(right)):
        for b in r.integers(0, 64, r.integers(0, 6)):
            right[k] ^= np.uint64(1) << np.uint64(b)
    a, b = simhash.near_pairs(left, right, radius)
    assert set(zip(a.tolist(), b.tolist())) == {(i, j) for i in range(150) for j in range(150) if bin(int(left[i]) ^ int(right[j])).count("1") <= radius}


def test_crowded_buckets_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 16)
    r = np.random.default_rng(5)
    values = {int(x) for x in r.integers(0, 1 << 62, 40)}
    centre = int(r.integers(0, 1 << 62))
    for _ in range(150):
        x = centre
        for b in r.integers(0, 64, r.integers(0, 8)):
            x ^= 1 << int(b)
        values.add(x)
    values = sorted(v - (1 << 64) if v >= 1 << 63 else v for v in values)
    rows = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "doc_id long, fingerprint long")
    got = simhash.labelled(rows).collect()
    expected = plain_components([(k, v & (1 << 64) - 1) for k, v in enumerate(values)])
    groups = lambda pairs: {frozenset(k for k, g in pairs if g == name) for name in {g for _, g in pairs}}
    assert groups([(x.doc_id, x.root) for x in got]) == groups([(d, c) for d, _, c in expected])


def test_long_chain_becomes_one_component(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(60)] + [(100, 101)], "node long, other long")
    got = {r.node: r.root for r in simhash.components(edges).collect()}
    assert all(got[k] == 0 for k in range(1, 61)) and got[101] == 100


@pytest.mark.parametrize("way", simhash.schemes())
def test_every_width_of_key_finds_every_link(spark, way):
    r = np.random.default_rng(way[1])
    values = []
    for _ in range(60):
        centre = int(r.integers(0, 1 << 63)) * 2
        values += [centre, *(centre ^ sum({1 << int(b) for b in r.integers(0, 64, 3)}) for _ in range(3))]
    values = sorted({v - (1 << 64) if v >= 1 << 63 else v for v in values})
    rows = spark.createDataFrame([(v,) for v in values], "fingerprint long")
    found = {r.node: r.root for r in simhash.components(simhash.links(rows, way=way)).collect()}
    groups = lambda pairs: {frozenset(k for k, g in pairs if g == name) for name in {g for _, g in pairs}}
    expected = plain_components([(k, v & (1 << 64) - 1) for k, v in enumerate(values)])
    assert groups([(k, found.get(v, v)) for k, v in enumerate(values)]) == groups([(d, c) for d, _, c in expected])


def test_rows_dealt_follow_the_fingerprints():
    """A bucket of evenly spread fingerprints stays within half a block up to the widest keys' 2^40, so no chunks are paired."""
    for bits in range(10, 41):
        blocks, chosen = simhash.scheme_for(1 << bits)
        assert (1 << bits) >> sum(sorted(w for _, w in blocks)[:chosen]) <= simhash.BLOCK // 2
        assert len(simhash.key_columns(simhash.F.lit(0), (blocks, chosen))) <= 20


def plain_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    target, open_, left = {}, set(names), 1.5 * sum(sizes.values())
    while open_:
        level = left / sum(weight[s] for s in open_)
        above = {s for s in open_ if level * weight[s] > 2 * sizes[s]}
        if not above:
            target |= {s: level * weight[s] for s in open_}
            break
        for s in above:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        open_ -= above
    return target


def test_mixture_meets_targets(spark, sf):
    for docs in (odd_documents(spark), documents(spark, sf)):
        rows = [r.asDict() for r in mixing.mixture(docs).collect()]
        texts = docs.select("doc_id", "text", "source").collect()
        assert Counter((r["doc_id"], r["source"], r["size"]) for r in rows) == Counter((r.doc_id, r.source, len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))) for r in texts)
        sizes = Counter()
        for r in rows:
            sizes[r["source"]] += r["size"]
        target = plain_targets({s: sizes[s] for s in {r["source"] for r in rows}})
        taken = Counter()
        for r in rows:
            assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(target[r["source"]])
            assert 0 <= r["taken"] <= 2 * r["size"] and r["taken"] == sum(x["last"] - x["first"] for x in r["takes"])
            taken[r["source"]] += r["taken"]
        for s in target:
            assert abs(taken[s] - target[s]) <= 1 + 0.03 * target[s]
        again = [r.asDict() for r in mixing.mixture(docs.repartition(7)).collect()]
        assert sorted(map(repr, again)) == sorted(map(repr, rows))
    assert mixing.mixture(empty_documents(spark)).count() == 0


def row_hash(*values):
    """The 64-bit hash of a row: text, 4-byte and 8-byte numbers in turn, each seeded with the one before; nulls are passed over."""
    seed = 42
    for kind, v in values:
        if v is not None:
            seed = xxhash.xxh64_intdigest(v.encode() if kind == "s" else int(v).to_bytes(4 if kind == "i" else 8, "little", signed=True), seed)
    return seed - (1 << 64) if seed >> 63 else seed


def plain_permuted(x, n, *key):
    for k in range(1, 25):
        mirror = (row_hash(("s", "pivot"), ("i", k), *key) % n - x) % n
        if row_hash(("s", "bit"), ("i", k), ("l", max(x, mirror)), *key) & 1:
            x = mirror
    return x


def plain_mix(items, block_words, shard_slots):
    """items: (doc_id, source, text) -> (doc_id, source, size, taken, slots) of each."""
    docs = [(d, s, len(re.findall(r"[^\x20\x09-\x0D]+", t or "")), row_hash(("l", d), ("s", s), ("s", t))) for d, s, t in items]
    total = Counter()
    for _, s, n, _ in docs:
        total[s] += n
    names = sorted((s for s in total if s is not None), key=lambda s: s.encode()) + [None] * (None in total)
    target = plain_targets(total)
    plan, all_slots = {}, 0
    for number, s in enumerate(names, 1):
        size, wanted = total[s], int(target[s] + 0.5)
        if not size or not wanted:
            continue
        bw = -(-size // -(-size // block_words))
        blocks = -(-size // bw)
        whole, rest = wanted // size * blocks + wanted % size // bw, wanted % size % bw
        plan[s] = (number, size, bw, blocks, whole, rest, all_slots, whole + (rest > 0))
        all_slots += whole + (rest > 0)
    used = {}
    for s, (number, size, bw, blocks, whole, rest, first, n) in plan.items():
        for slot in range(n):
            block = plain_permuted(slot % blocks, blocks, ("l", number), ("l", slot // blocks))
            out = plain_permuted(first + slot, all_slots, ("s", "shards"))
            length = min(bw, size - block * bw)
            used.setdefault((s, block), []).append((length if slot < whole else min(length, rest), out // shard_slots, out % shard_slots))
    n_buckets = max(1, -(-len(docs) // mixing.BUCKET_ROWS))
    at, found = Counter(), []
    for d, s, n, h in sorted(docs, key=lambda x: (row_hash(("l", x[3]), ("l", x[0])) % n_buckets, x[3], x[0] is not None, x[0] or 0)):
        start, taken, slots = at[s], 0, []
        at[s] += n
        if n and s in plan:
            bw = plan[s][2]
            for block in range(start // bw, (start + n - 1) // bw + 1):
                for words, shard, place in used.get((s, block), []):
                    took = min(block * bw + words, start + n) - max(block * bw, start)
                    if took > 0:
                        taken += took
                        slots.append((shard, place))
        found.append((d, s, n, taken, ",".join(f"{a}:{b}" for a, b in sorted(slots))))
    return found


@pytest.mark.parametrize("block_words, shard_slots", [(1024, 256), (64, 16), (7, 3)])
def test_the_whole_mix_by_plain_code(spark, sf, block_words, shard_slots):
    from pyspark.sql import functions as F

    for docs in (odd_documents(spark), documents(spark, sf)):
        rows = mixing.mixture(docs, block_words=block_words, shard_slots=shard_slots).withColumn("slots", mixing.slot_text(F.col("takes")))
        got = Counter((r.doc_id, r.source, r["size"], r.taken, r.slots) for r in rows.collect())
        assert got == Counter(plain_mix([(r.doc_id, r.source, r.text) for r in docs.select("doc_id", "source", "text").collect()], block_words, shard_slots))


def test_permutations_are_permutations(spark):
    from pyspark.sql import functions as F

    for n in (1, 2, 7, 100, 257):
        got = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n), F.lit("k")).alias("p")).collect()
        assert sorted(r.p for r in got) == list(range(n))


def test_mixed_texts_hold_the_words_taken(spark, sf):
    for docs in (odd_documents(spark), documents(spark, sf)):
        taken = sum(r.taken for r in mixing.mixture(docs).select("taken").collect())
        out = mixing.mixed(docs)
        assert out.columns == docs.columns and out.schema["text"].dataType == docs.schema["text"].dataType
        rows = out.collect()
        words = sum(len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for r in rows)
        assert words == pytest.approx(taken, rel=0.01) and all(r.n_chars == len(r.text) for r in rows)


def plain_sums(text):
    """(pieces, 128 counts of bits, 32 lanes modulo 2^16 in the order of the hexadecimal digits)."""
    pieces = re.findall(r"[^\n.!?]+[.!?]*|[.!?]+", text)
    counts, lanes = np.zeros(128, np.int64), np.zeros(32, np.int64)
    for p in pieces:
        first, second = hashlib.sha256(b"0" + p.encode()).digest(), hashlib.sha256(b"1" + p.encode()).digest()
        for k, v in enumerate((int.from_bytes(first[:8], "big"), int.from_bytes(first[8:16], "big"))):
            for j in range(32):
                counts[k * 64 + 2 * j] += v >> (32 + j) & 1
                counts[k * 64 + 2 * j + 1] += v >> j & 1
        lanes = (lanes + np.frombuffer(first + second, ">u2")) % 65536
    return len(pieces), counts, lanes


def test_fingerprints_by_plain_loops(spark, sf):
    for docs in (odd_documents(spark).where("doc_id is not null").dropDuplicates(["doc_id"]), documents(spark, sf)):
        rows = sorted(((r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()), reverse=True)
        got = {r.doc_id: r for r in fingerprints.compared(docs).collect()}
        assert len(got) == len(rows)
        hexes = lambda s: f"{s[0]:016x}" + "".join(f"{s[1][2 * k]:08x}{s[1][2 * k + 1]:08x}" for k in range(64)) + "".join(f"{x:04x}" for x in s[2])

        def near(a, b):
            if hexes(a) == hexes(b):
                return 1.0
            fa, fb = 2 * a[1] - a[0], 2 * b[1] - b[0]
            return max(0.0, 1 - float(((fa - fb) ** 2).sum()) / float((fa**2).sum() + (fb**2).sum()))

        for k, (doc_id, text) in enumerate(rows):
            following = rows[(k + 1) % len(rows)][1]
            cut = len(text) // 3
            edited = text[: len(text) - cut] + following[:cut]
            r = got[doc_id]
            own, new, other = plain_sums(text), plain_sums(edited), plain_sums(following)
            assert (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint) == (len(text), hashlib.sha256(edited.encode()).hexdigest(), hexes(own), hexes(new))
            assert r.near_edited == pytest.approx(near(own, new)) and r.near_next == pytest.approx(near(own, other))
    assert fingerprints.compared(empty_documents(spark)).count() == 0
    assert fingerprints.compared(odd_documents(spark)).count() == odd_documents(spark).count()


def test_fingerprints_add_up(spark):
    df = spark.createDataFrame([("a b.\nc d.\n", "e f!\n", "e f!\nc d.\na b.\n")], "x string, y string, both string")
    from pyspark.sql import functions as F

    sums = {c: fingerprints.lane_sums(fingerprints.piece_hashes(F.col(c))) for c in df.columns}
    r = df.select(*[v.alias(c) for c, v in sums.items()]).select("x", "both", fingerprints.combined(F.col("x"), F.col("y")).alias("sum"), fingerprints.combined(F.col("both"), F.col("y"), -1).alias("less")).first()
    assert r.sum == r.both and r.less == r.x


def test_mix_comes_out_shard_by_shard(spark, sf, monkeypatch):
    from pyspark.sql import functions as F

    planned = []
    slots = mixing.slots
    monkeypatch.setattr(mixing, "slots", lambda *given: planned.append(slots(*given)) or planned[-1])
    monkeypatch.setattr(mixing, "TASK_SHARD_SLOTS", 64)
    docs = documents(spark, sf)
    mix = mixing.mixed(docs, block_words=256, shard_slots=16).select("doc_id", "source", "text", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("row")).orderBy("row").collect()
    rows = mixing.dealt(docs, block_words=256, shard_slots=16).select("shard", "place", "at", "row.*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("n")).orderBy("n").collect()
    assert [(r.doc_id, r.text) for r in rows] == [(r.doc_id, r.text) for r in mix]
    assert len({(r.shard, r.part) for r in rows}) == len({r.shard for r in rows}) > 10
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))
    source_of, filled, last = {}, Counter(), None
    for r in rows:
        slot = (r.shard, r.place)
        assert last is None or last[0] != r.part or last[1:] < (*slot, r.at)
        last = (r.part, *slot, r.at)
        assert source_of.setdefault(slot, r.source) == r.source and r.at == filled[slot]
        filled[slot] += words(r.text)
    assert filled == Counter({(r.shard, r.place): r.words for r in planned[0].collect()})
    # a shard holds several sources: a draw, not one source after the other
    assert sum(len({s for (k, _), s in source_of.items() if k == shard}) > 1 for shard in {k for k, _ in source_of}) > 0.9 * len({k for k, _ in source_of})


def test_rows_with_maps_and_dotted_names_are_mixed(spark):
    rows = [(k, f"words of text number {k} here", f"s{k % 2}", "x", {"a": k}) for k in range(40)]
    docs = spark.createDataFrame([*rows, rows[0], rows[0]], "doc_id long, text string, source string, `a.b` string, m map<string,int>")
    out = mixing.mixed(docs, block_words=8)
    assert out.columns == docs.columns
    for r in out.collect():
        assert r.m == {"a": r.doc_id} and set(r.text.split()) <= set(rows[r.doc_id][1].split())


def test_sums_wrap_and_groups_add_up(spark, monkeypatch):
    """Texts of many pieces, in groups of few: lanes pass 2^16 many times."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(fingerprints, "WIDE_GROUP", 7)
    texts = ["".join(f"piece {k % 500} of {n}.\n" for k in range(n)) for n in (0, 1, 126, 127, 128, 300, 2000)]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, text string")
    for r in df.select("k", fingerprints.lane_sums(fingerprints.piece_hashes(F.col("text"))).alias("s")).collect():
        n, counts, lanes = plain_sums(texts[r.k])
        got = [x & (1 << 64) - 1 for x in r.s]
        assert got[0] == n and [y for x in got[1:65] for y in (x >> 32, x & 0xFFFFFFFF)] == counts.tolist()
        assert [x >> at & 0xFFFF for x in got[65:] for at in (48, 32, 16, 0)] == lanes.tolist()


def test_next_rows_where_many_share_an_id(spark, monkeypatch):
    """Null ids and one common id are cut into buckets by ties; the order is that of a plain sort."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(fingerprints, "BUCKET_ROWS", 8)
    monkeypatch.setattr(fingerprints, "QUANTILES", 4)
    rows = [(k, f"t{k}") for k in range(60)] + [(17, f"same {k}") for k in range(100)] + [(None, f"none {k}") for k in range(90)] + [(-5, "x"), ((1 << 63) - 1, "top")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("tie", F.xxhash64("text"))
    buckets = fingerprints.bucketed(df)[0].groupBy("bucket").count().collect()
    assert max(r["count"] for r in buckets) <= 40 and len(buckets) > 20
    plain = sorted(((r.doc_id, r.tie, r.text) for r in df.collect()), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    got = {r.text: r.next_text for r in fingerprints.with_next(df, ["text"]).collect()}
    assert got == {text: plain[(k + 1) % len(plain)][2] for k, (_, _, text) in enumerate(plain)}
