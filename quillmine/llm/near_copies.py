"""Near copies of texts: SimHash candidates, then the similarity of the texts themselves.

Two texts are near copies if the sets of their shingles of five words have a Jaccard similarity of 0.8 or more. Buckets
come from bands of minima of keyed shingle hashes, which such texts share almost surely; within a bucket the bit-sliced
comparison of SimHash fingerprints keeps pairs within a wide radius. Texts that candidates connect meet once more with
their shingles, and only pairs that are similar enough are links. Of each component of links one document stays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmine.llm.common import give_back_memory, row_columns, row_struct, stored
from quillmine.llm.simhash import SEED, bucket_links, components, crowded_links, in_groups, near_pairs, spanning

SHINGLE, SIMILARITY = 5, 0.8
#: Two texts at the least similarity differ in 10 of 64 bits on average; beyond this many lies about one pair in 10^6.
RADIUS = 24
#: Bands, and minima in each: texts at the least similarity share no band with a probability of (1 - 0.8^4)^20 < 10^-4.
BANDS, ROWS = 20, 4
#: Texts, and bytes of text, that a comparison of texts holds about; more are cut into chunks.
TEXTS, TEXT_BYTES = 1024, 1 << 24
#: Shingles whose minima are taken at once.
AT_ONCE = 2048

_KEYS = np.random.default_rng(64).integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_hashes(text: str | None, width: int = SHINGLE) -> np.ndarray:
    """XXH64 of each shingle of lower-cased words, repeats included; fewer words than a shingle are one, no words an empty one."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    joined, hashed = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= width:
        return np.array([hashed(joined, SEED)], np.uint64)
    ends = (np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1)[width - 1 :].tolist()
    starts = np.concatenate([[0], np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)])[: len(ends)].tolist()
    return np.fromiter((hashed(joined[a:b], SEED) for a, b in zip(starts, ends)), np.uint64, len(ends))


def sketch(hashes: np.ndarray) -> tuple[int, list[int]]:
    """(SimHash as a signed number, a key for each band)."""
    counts, least = np.zeros(64, np.int64), np.full(len(_KEYS), np.iinfo(np.uint64).max)
    for at in range(0, len(hashes), AT_ONCE):
        part = hashes[at : at + AT_ONCE]
        counts += np.unpackbits(part.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
        mixed = part ^ (part >> np.uint64(31))
        np.minimum(least, (mixed[:, None] * _KEYS).min(axis=0), out=least)
    fingerprint = np.packbits(counts * 2 > len(hashes)).view(">i8")
    bands = least.reshape(BANDS, ROWS)
    keys = np.arange(BANDS, dtype=np.uint64)
    for k in range(ROWS):
        keys = (keys ^ bands[:, k]) * np.uint64(0x9E3779B97F4A7C15)
        keys ^= keys >> np.uint64(29)
    return int(fingerprint[0]), keys.view(np.int64).tolist()


def sketch_column(text: Column, width: int = SHINGLE) -> Column:
    @F.pandas_udf("fingerprint long, bands array<long>")
    def sketches(texts: pd.Series) -> pd.DataFrame:
        found = [sketch(shingle_hashes(x, width)) for x in texts]
        give_back_memory()
        return pd.DataFrame({"fingerprint": [x for x, _ in found], "bands": [x for _, x in found]}, columns=["fingerprint", "bands"])

    return sketches(text)


def similar_links(sets: list[np.ndarray], prints: np.ndarray, split: int | None, similarity: float, radius: int) -> list[tuple[int, int]]:
    """Spanning links of the texts (sorted different hashes of each) by pairs that are within the radius and similar enough;
    split: pairs of one before it with one from it on only. A pair whose texts are linked already is not looked at: so a
    group of like texts takes about as many comparisons as it has texts. The nearest pairs come first."""
    left, right = (prints, prints) if split is None else (prints[:split], prints[split:])
    a, b = near_pairs(left, right, radius)
    if split is None:
        a, b = a[a < b], b[a < b]
    else:
        b = b + split
    sizes = np.array([len(x) for x in sets])
    fits = np.minimum(sizes[a], sizes[b]) >= similarity * np.maximum(sizes[a], sizes[b])
    a, b = a[fits], b[fits]
    order = np.argsort(np.bitwise_count(prints[a] ^ prints[b]), kind="stable")
    root = list(range(len(sets)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    found = []
    for i, j in zip(a[order].tolist(), b[order].tolist()):
        x, y = find(i), find(j)
        if x == y:
            continue
        small, large = (sets[i], sets[j]) if sizes[i] <= sizes[j] else (sets[j], sets[i])
        at = np.searchsorted(large, small)
        at[at == len(large)] = 0
        common = int((large[at] == small).sum())
        if common >= similarity * (len(small) + len(large) - common):
            root[x] = y
            found.append((i, j))
    return found


def text_groups(batches: Iterator[pd.DataFrame], by: list[str], width: int) -> Iterator[tuple[tuple, list[str], list[np.ndarray], np.ndarray, int | None]]:
    """(group, nodes, shingles of each, fingerprints, where the second side begins) of groups of two texts and more, from
    batches of node, text, the columns that tell groups apart and, if there is one, side, in order."""
    names: list[str] = []
    sets: list[np.ndarray] = []
    prints: list[int] = []
    sides: list[int] = []
    group = None
    for batch in batches:
        for own, node, text, side in zip(zip(*[batch[c] for c in by]), batch["node"], batch["text"], batch["side"] if "side" in batch else [0] * len(batch)):
            if own != group:
                if len(names) > 1:
                    yield group, names, sets, np.array(prints, np.int64).view(np.uint64), sides.index(1) if 1 in sides else None
                names, sets, prints, sides, group = [], [], [], [], own
            hashes = shingle_hashes(text, width)
            names.append(node)
            sides.append(side)
            prints.append(sketch_print(hashes))
            sets.append(np.unique(hashes))
    if len(names) > 1:
        yield group, names, sets, np.array(prints, np.int64).view(np.uint64), sides.index(1) if 1 in sides else None


def text_links(members: DataFrame, width: int, similarity: float, radius: int) -> DataFrame:
    """members: key, node (the text's digest), text, chunks (into which the key's texts are cut), one row per text and key.
    Links (node, other) between texts of one key, whose components are those of all similar pairs of it."""

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _, names, sets, prints, split in text_groups(batches, ["key", "low", "high"], width):
            found = similar_links(sets, prints, split, similarity, radius) if split != 0 else []
            yield pd.DataFrame({"node": [names[i] for i, _ in found], "other": [names[j] for _, j in found]}, columns=["node", "other"], dtype="object")
        give_back_memory()

    def label(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for (key, _), names, sets, prints, _ in text_groups(batches, ["key", "part"], width):
            found = np.array(similar_links(sets, prints, None, similarity, radius), np.int64).reshape(-1, 2)
            root = spanning(len(names), found[:, 0], found[:, 1])
            moved = np.flatnonzero(root != np.arange(len(names)))
            yield pd.DataFrame({"key": np.full(len(moved), key, np.int64), **{c: pd.Series([names[k] for k in which], dtype="object") for c, which in (("node", moved), ("root", root[moved]))}})
        give_back_memory()

    cross = lambda rows: in_groups(rows).select("key", "low", "high", "side", "node", "text").mapInPandas(compare, "node string, other string")
    roots = lambda rows: rows.repartition("key", "part").sortWithinPartitions("key", "part").select("key", "part", "node", "text").mapInPandas(label, "key long, node string, root string")
    alone = members.where("chunks = 1").select("key", "node", "text", F.lit(0).alias("low"), F.lit(0).alias("high"), F.lit(0).alias("side"))
    crowded = members.where("chunks > 1")
    found = cross(alone)
    return (found if crowded.isEmpty() else found.unionByName(crowded_links(crowded, ["text"], roots, cross))).dropDuplicates()


def sketch_print(hashes: np.ndarray) -> int:
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), AT_ONCE):
        counts += np.unpackbits(hashes[at : at + AT_ONCE].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes)).view(">i8")[0])


def _keys(doc_id: Column, text: Column) -> list[Column]:
    """What a row is known by: its id (two columns, as joins pass over nulls) and the digest of its text, null as empty."""
    number = doc_id.cast("long")
    return [F.coalesce(number, F.lit(0).cast("long")).alias("id_key"), number.isNull().alias("no_id"), F.md5(F.coalesce(text.cast("string"), F.lit("")).cast("binary")).alias("copy")]


def deduplicated(docs: DataFrame, width: int = SHINGLE, similarity: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """docs with one document of each class of near copies: the one with the smallest doc_id (null last), and of equal ids
    that with the least digest of its text.

    Texts without words (null, empty) are copies of each other; a text of fewer words than a shingle is like those with the
    same words only; of rows with one id and text one stays; an empty table gives no rows; other columns may have any names
    and are kept. docs is read twice: store it first if it is dear to compute.
    """
    columns, keys = docs.columns, ["no_id", "id_key", "copy"]
    known_by = _keys(F.col("doc_id"), F.col("text"))
    n_bytes = F.coalesce(F.octet_length(F.col("text").cast("string")), F.lit(0))
    rows = stored(docs.select(*known_by, n_bytes.alias("n_bytes"), sketch_column(F.col("text").cast("string"), width).alias("sketch")), "sketches")
    # one row per text: a large group of exact copies is one node
    texts = rows.groupBy("copy").agg(F.min(F.struct("no_id", "id_key")).alias("first"), F.first("n_bytes").alias("n_bytes"), F.first("sketch").alias("sketch"))
    # the number only leads to candidates; two texts that share it by chance are told apart by their shingles
    texts = stored(texts.select("copy", F.conv(F.substring("copy", 1, 16), 16, -10).cast("long").alias("node"), "first", "n_bytes", "sketch.fingerprint", "sketch.bands"), "texts")
    # two similar texts that share a bucket are linked to the same least node there, or one of them is that node
    found = stored(bucket_links(texts.select("node", "fingerprint", F.explode("bands").alias("key")), radius, joined=False), "candidate-links")
    pairs = found.select("node", F.col("other").alias("centre")).unionByName(found.select(F.col("other").alias("node"), F.col("other").alias("centre")).distinct())
    members = texts.select("copy", "node", "n_bytes").join(pairs, "node").select("copy", "centre", "n_bytes")
    size = F.greatest(F.count(F.lit(1)) / TEXTS, F.sum("n_bytes") / TEXT_BYTES)
    crowded = members.groupBy("centre").agg(size.alias("size")).where("size > 1").select("centre", F.ceil(2 * F.col("size")).cast("int").alias("chunks"))
    members = stored(members.join(crowded, "centre", "left").select("copy", "centre", F.coalesce("chunks", F.lit(1)).alias("chunks")), "members")
    firsts = texts.select("first.*", "copy").join(members.select("copy").distinct().withColumn("candidate", F.lit(True)), "copy", "left").withColumn("candidate", F.coalesce("candidate", F.lit(False)))
    # the texts move once, whatever the tables' sizes; rows that are not the first of their text go
    first_rows = stored(docs.select(row_struct(columns), *known_by).join(firsts.hint("merge"), keys), "first-rows")
    if first_rows.count() > texts.count():  # rows of one id and text
        first_rows = stored(first_rows.groupBy(*keys, "candidate").agg(F.first("row").alias("row")), "first-rows")
    candidates = first_rows.where("candidate").select("copy", F.col("row").getField("text").cast("string").alias("text"))
    linked = components(text_links(stored(candidates.join(members, "copy").select(F.col("centre").alias("key"), F.col("copy").alias("node"), "text", "chunks"), "candidates"), width, similarity, radius))
    classes = firsts.where("candidate").join(linked.withColumnRenamed("node", "copy"), "copy", "left").withColumn("class", F.coalesce("root", "copy"))
    kept = classes.groupBy("class").agg(F.min(F.struct("no_id", "id_key", "copy")).alias("first")).select("first.copy")
    alone = first_rows.where("not candidate").select("row")
    return alone.unionByName(first_rows.where("candidate").join(kept, "copy").select("row")).select(*row_columns(columns))
