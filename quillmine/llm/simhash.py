"""SimHash near-duplicates: 64-bit fingerprints of word shingles, linked within a Hamming radius by bit-sliced comparison.

Fingerprints cut into radius + k blocks of bits agree on k of them if they are within the radius, so every link lies
within a bucket of one of the keys made of k blocks. k follows the number of fingerprints: radius 3 takes 4 keys of 16
bits, 10 of 25 or 20 of 31, and a bucket of evenly spread fingerprints stays small. Buckets are dealt out as a table of
distinct fingerprints; a bucket with many is cut into chunks, whose components are joined by their first nodes, so that
only what stays outside the largest component is compared with every chunk. In a task, fingerprints
lie in bit planes; distances of one block to another add up plane by plane in carry-save counters, 64 at a time, and a
block is abandoned once every counter is above the radius. A block gives a spanning set of its links, not every pair.
Stars of links are then merged to components by joins.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmine.llm.common import give_back_memory, remove, stored, stored_at

SHINGLE, RADIUS, SEED = 3, 3, 42
#: Fingerprints that are compared at once, and the size from which a bucket is cut into chunks.
BLOCK = 1024
#: Components of chunks, the largest of a key, whose first nodes are compared to join them.
SEEDS = 512
#: Rows of small groups that are compared together.
TOGETHER = 256
#: Rows of one fingerprint that are joined in one slice.
HOT = 1 << 16
#: Planes between two looks at whether a block can be abandoned.
LOOK = 8


def text_fingerprint(text: str | None, width: int = SHINGLE) -> int:
    """A bit is 1 if it is set in over half of the shingles' XXH64. No words: 0. Hashes are counted a bounded number at a time."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined, hashed = b" ".join(words), xxhash.xxh64_intdigest
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    if len(words) >= width:
        starts, ends = starts[: len(words) - width + 1], ends[width - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    counts = np.zeros(64, np.int64)
    for at in range(0, len(starts), 1 << 16):
        hashes = np.array([hashed(joined[a:b], SEED) for a, b in zip(starts[at : at + (1 << 16)].tolist(), ends[at : at + (1 << 16)].tolist())], dtype=">u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(starts)).tobytes(), "big")


def fingerprint_column(text: Column, width: int = SHINGLE) -> Column:
    @F.pandas_udf("long")
    def fingerprint(texts: pd.Series) -> pd.Series:
        found = np.array([text_fingerprint(x, width) for x in texts], dtype=np.uint64).astype(np.int64)
        give_back_memory()
        return pd.Series(found)

    return fingerprint(text)


def planes(fingerprints: np.ndarray) -> np.ndarray:
    """(64, words) bit planes: bit i of plane b is bit b of fingerprint i."""
    bits = np.unpackbits(fingerprints.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).T
    padded = np.zeros((64, -(-len(fingerprints) // 64) * 64), np.uint8)
    padded[:, : len(fingerprints)] = bits
    return np.packbits(padded, axis=1, bitorder="little").view(np.uint64)


def above(counters: list[np.ndarray], over: np.ndarray, radius: int) -> np.ndarray:
    """Where the number that the counter planes hold is above the radius."""
    more, same = over.copy(), ~over
    for k in reversed(range(len(counters))):
        if radius >> k & 1:
            same = same & counters[k]
        else:
            more |= same & counters[k]
            same = same & ~counters[k]
    return more


def near_pairs(left: np.ndarray, right: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Indices (into left, into right) of all pairs within the radius.

    For each row of left, planes of counters hold its distances to 64 fingerprints of right a word; a plane of differing
    bits is added by carries from plane to plane, and what leaves the last one is kept as overflow.
    """
    found_left, found_right = [], []
    vertical = planes(right)
    valid = np.zeros(vertical.shape[1] * 64, np.uint8)
    valid[: len(right)] = 1
    valid = np.packbits(valid, bitorder="little").view(np.uint64)
    rows = max(1, (1 << 16) // max(1, vertical.shape[1]))
    for at in range(0, len(left), rows):
        bits = np.unpackbits(left[at : at + rows].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        flips = (-(bits.astype(np.int64))).view(np.uint64)
        over = np.zeros((len(bits), vertical.shape[1]), np.uint64)
        counters = [np.zeros_like(over) for _ in range(max(1, radius.bit_length()))]
        over |= ~valid
        live = np.arange(len(bits))
        for b in range(64):
            carry = vertical[b][None, :] ^ flips[live, b][:, None]
            for plane in counters:
                beyond = plane & carry
                plane ^= carry
                carry = beyond
            over |= carry
            if b % LOOK == LOOK - 1 and b < 63:
                keep = (~above(counters, over, radius)).any(axis=1)
                if not keep.any():
                    live = live[:0]
                    break
                if not keep.all():
                    live, over, counters = live[keep], over[keep], [plane[keep] for plane in counters]
        if not len(live):
            continue
        near = ~above(counters, over, radius)
        row, bit = np.nonzero(np.unpackbits(near.view(np.uint8), axis=1, bitorder="little"))
        found_left.append(at + live[row])
        found_right.append(bit)
    if not found_left:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(found_left), np.concatenate(found_right)


def spanning(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least index of each node's component, by repeated minima and jumps."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        while (new != new[new]).any():
            new = new[new]
        if (new == root).all():
            return root
        root = new


def block_links(left: np.ndarray, right: np.ndarray | None, radius: int, groups: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """left, right: columns node and fingerprint. (node, least node linked to it within this block) for all but the least.
    groups: a number for each row of left; only rows of one group are linked."""
    rows = left if right is None else np.concatenate([left, right])
    prints = np.ascontiguousarray(rows[:, 1]).view(np.uint64)
    a, b = near_pairs(prints[: len(left)], prints if right is None else prints[len(left) :], radius)
    b = b if right is None else b + len(left)
    if groups is not None:
        same = groups[a] == groups[b]
        a, b = a[same], b[same]
    if groups is None:
        nodes, rank = np.unique(rows[:, 0], return_inverse=True)
        label = nodes
    else:  # a node has a place in each of its groups
        order = np.lexsort((rows[:, 0], groups))
        rank = np.empty_like(order)
        rank[order] = np.arange(len(order))
        label = rows[order, 0]
    if not len(a):
        return label[:0], label[:0]
    root = spanning(len(label), rank[a], rank[b])
    moved = label != label[root]
    return label[moved], label[root[moved]]


def schemes(radius: int = RADIUS) -> list[tuple[list[tuple[int, int]], int]]:
    """Ways to make keys, widest last: (blocks of bits as (lowest bit, width), blocks in a key). Of radius + k blocks, k have
    no differing bit if two fingerprints are within the radius, so they share at least one key of k blocks."""
    found = []
    for chosen in range(1, 4):
        edges = [64 * k // (radius + chosen) for k in range(radius + chosen + 1)]
        found.append(([(a, b - a) for a, b in zip(edges, edges[1:])], chosen))
    return found


def scheme_for(n: int, radius: int = RADIUS) -> tuple[list[tuple[int, int]], int]:
    """The narrowest keys whose buckets hold no more than half a block of n evenly spread fingerprints: so the rows that
    are dealt out follow n, not its square."""
    ways = schemes(radius)
    return next((way for way in ways if n >> sum(sorted(w for _, w in way[0])[: way[1]]) <= BLOCK // 2), ways[-1])


def key_columns(fingerprint: Column, way: tuple[list[tuple[int, int]], int]) -> list[Column]:
    """One key for each choice of blocks: the number of the choice, then the blocks' bits."""
    blocks, chosen = way
    out = []
    for number, choice in enumerate(combinations(blocks, chosen)):
        key = F.lit(number).cast("long")
        for low, width in choice:
            key = F.shiftleft(key, width).bitwiseOR(F.shiftrightunsigned(fingerprint, low).bitwiseAND(F.lit((1 << width) - 1).cast("long")))
        out.append(key)
    return out


def with_pairs(rows: DataFrame, spread: Column, chunks: Column) -> DataFrame:
    """rows with low, high, side: all of a key's rows meet in the groups (key, low, high), each of at most two of the key's
    chunks; side 0 is the chunk low, side 1 the chunk high, and where low = high all is side 0. spread deals rows over
    chunks; the number of chunks must be the same for a key's rows."""
    chunk = F.pmod(spread, chunks).cast("int")
    # a chunk meets each chunk once
    meet = F.transform(F.sequence(F.lit(0), chunks.cast("int") - 1), lambda j: F.struct(F.least(j, chunk).alias("low"), F.greatest(j, chunk).alias("high"), (chunk > j).cast("int").alias("side")))
    return rows.withColumn("pair", F.explode(meet)).select("*", "pair.*").drop("pair")


def block_compare(radius: int, joined: bool):
    """A function over batches (node, fingerprint, key, low, high, side) in order -> (node, other): spanning links of each
    group. joined: the nodes are the fingerprints themselves, so that small groups can be compared together."""

    def out(a, b):
        return pd.DataFrame({"node": a.astype(np.int64), "other": b.astype(np.int64)})

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[np.ndarray] = []
        count = 0

        def group(rows: np.ndarray) -> Iterator[pd.DataFrame]:
            nonlocal count
            if len(rows) < 2:
                return
            side = rows[:, 5] == 1
            if side.any():
                yield out(*block_links(rows[~side, :2], rows[side, :2], radius))
            elif len(rows) >= TOGETHER:
                yield out(*block_links(rows[:, :2], None, radius))
            else:
                held.append(rows[:, :2])
                count += len(rows)
                if count >= TOGETHER:
                    yield from settle()

        def settle() -> Iterator[pd.DataFrame]:
            """Small groups are compared together. Where only fingerprints are compared, a link between two groups is a true one
            as well."""
            nonlocal count
            if held and joined:
                yield out(*block_links(np.unique(np.concatenate(held), axis=0), None, radius))
            elif held:
                yield out(*block_links(np.concatenate(held), None, radius, np.repeat(np.arange(len(held)), [len(x) for x in held])))
            held.clear()
            count = 0

        last = np.empty((0, 6), np.int64)
        for batch in batches:
            rows = np.concatenate([last, batch[["node", "fingerprint", "key", "low", "high", "side"]].to_numpy(np.int64)])
            cuts = np.flatnonzero((rows[1:, 2:5] != rows[:-1, 2:5]).any(axis=1)) + 1
            edges = [0, *cuts.tolist(), len(rows)]
            for a, b in zip(edges[:-2], edges[1:-1]):
                if b - a > 1:
                    yield from group(rows[a:b])
            last = rows[edges[-2] :]
        yield from group(last)
        yield from settle()
        give_back_memory()

    return compare


def group_roots(radius: int):
    """A function over batches (node, fingerprint, key, part) in order -> (key, node, root): of each group the least node of its
    component for all nodes but that."""

    def roots(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last = np.empty((0, 4), np.int64)

        def settle(rows: np.ndarray) -> pd.DataFrame:
            node, root = block_links(rows[:, :2], None, radius)
            return pd.DataFrame({"key": rows[0, 2], "node": node.astype(np.int64), "root": root.astype(np.int64)})

        for batch in batches:
            rows = np.concatenate([last, batch[["node", "fingerprint", "key", "part"]].to_numpy(np.int64)])
            edges = [0, *(np.flatnonzero((rows[1:, 2:] != rows[:-1, 2:]).any(axis=1)) + 1).tolist(), len(rows)]
            for low, high in zip(edges[:-2], edges[1:-1]):
                if high - low > 1:
                    yield settle(rows[low:high])
            last = rows[edges[-2] :]
        if len(last) > 1:
            yield settle(last)
        give_back_memory()

    return roots


def crowded_links(members: DataFrame, payload: list[str], roots: Callable[[DataFrame], DataFrame], cross: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Links (node, other) of keys that hold more than one task compares: members has key, node, chunks and payload columns.

    First each chunk is linked on its own, then the first nodes of the largest of what came out, so that a key's like members
    become one component without a pair of chunks. Only members that are not in a key's largest component are still compared
    with all others: with each other, and with each chunk of the component. So no link is lost, what is dealt out follows the
    number of members where they are alike, and all members of that component are linked to one node.

    roots: rows with key, part -> (key, node, root) of each group (key, part), for nodes that are not their root.
    cross: rows with key, low, high, side -> links (node, other) of each group, between its sides where it has two."""
    own = members.withColumn("part", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
    local = stored(roots(own.select("key", "part", "node", *payload)), "local-roots")
    sizes = local.groupBy("key", "root").agg((F.count(F.lit(1)) + 1).alias("size"))
    largest = sizes.withColumn("place", F.row_number().over(Window.partitionBy("key").orderBy(F.col("size").desc(), "root"))).where(F.col("place") <= SEEDS)
    largest = stored(largest.select("key", "root", "size"), "seeds")
    seeds = members.join(largest.select("key", F.col("root").alias("node")), ["key", "node"], "left_semi").withColumn("part", F.lit(0))
    joined = roots(seeds.select("key", "part", "node", *payload)).select("key", F.col("node").alias("root"), F.col("root").alias("hub"))
    hubs = stored(largest.join(joined, ["key", "root"], "left").withColumn("hub", F.coalesce("hub", "root")), "hubs")
    best = hubs.groupBy("key", "hub").agg(F.sum("size").alias("size")).groupBy("key").agg(F.max_by("hub", F.struct("size", "hub")).alias("hub"))
    inside = hubs.join(best, ["key", "hub"]).select("key", "root", "hub")
    placed = own.select("key", "node", "part", "chunks").join(local, ["key", "node"], "left").withColumn("root", F.coalesce("root", "node"))
    placed = stored(placed.join(inside, ["key", "root"], "left").select("key", "node", "part", "chunks", "hub"), "placed")
    inner = placed.where("hub is not null and node <> hub").select("node", F.col("hub").alias("other"))
    outer = placed.where("hub is null").select("key", "node", "chunks")
    shares = placed.groupBy("key").agg(F.count_if(F.col("hub").isNull()).alias("n_outer"), F.count(F.lit(1)).alias("n"), F.max("chunks").alias("chunks")).where("n_outer > 0")
    shares = stored(shares.select("key", F.greatest(F.lit(1), F.ceil(F.col("n_outer") / F.col("n") * F.col("chunks"))).cast("int").alias("own_chunks")), "rest")
    alike = members.select("key", "node", *payload)
    outer = alike.join(outer.join(shares, "key"), ["key", "node"])
    among = with_pairs(outer, F.xxhash64("node"), F.col("own_chunks")).select("key", "low", "high", "side", "node", *payload)
    # a chunk of the rest meets a chunk of the component in the group (chunk, -1 - chunk of the rest)
    turn = lambda k: (-1 - k).cast("int")
    meets = outer.withColumn("low", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).withColumn("high", turn(F.pmod(F.xxhash64("node"), F.col("own_chunks"))))
    meets = meets.select("key", "low", "high", F.lit(1).alias("side"), "node", *payload)
    met = alike.join(placed.where("hub is not null").join(shares, "key").select("key", "node", "part", "own_chunks"), ["key", "node"])
    met = met.withColumn("turn", F.explode(F.sequence(F.lit(0), F.col("own_chunks") - 1)))
    met = met.select("key", F.col("part").alias("low"), turn(F.col("turn")).alias("high"), F.lit(0).alias("side"), "node", *payload)
    return inner.unionByName(cross(among.unionByName(meets).unionByName(met)))


def in_groups(rows: DataFrame) -> DataFrame:
    return rows.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high", "side")


def bucket_links(keyed: DataFrame, radius: int, joined: bool) -> DataFrame:
    """keyed: node, fingerprint, key. Links (node, other) whose components are those of all pairs that share a key and are
    within the radius: at most one link per node and group. Two such nodes of a key are linked to one node there."""
    names = ["node", "fingerprint", "key", "low", "high", "side"]
    cross = lambda rows: in_groups(rows).select(*names).mapInPandas(block_compare(radius, joined), "node long, other long")
    roots = lambda rows: rows.repartition("key", "part").sortWithinPartitions("key", "part").select("node", "fingerprint", "key", "part").mapInPandas(group_roots(radius), "key long, node long, root long")
    crowded = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("members")).where(F.col("members") > BLOCK)
    crowded = stored(crowded.select("key", F.ceil(F.col("members") / (BLOCK // 2)).cast("int").alias("chunks")), "crowded-keys")
    alone = lambda rows: rows.select("node", "fingerprint", "key", F.lit(0).alias("low"), F.lit(0).alias("high"), F.lit(0).alias("side"))
    if crowded.isEmpty():
        return cross(alone(keyed)).dropDuplicates()
    found = crowded_links(stored(keyed.join(crowded, "key"), "crowded-members"), ["fingerprint"], roots, cross)
    return found.unionByName(cross(alone(keyed.join(crowded, "key", "left_anti")))).dropDuplicates()


def links(nodes: DataFrame, radius: int = RADIUS, way: tuple | None = None) -> DataFrame:
    """Distinct fingerprints (column fingerprint) -> links (node, other) whose components are those of all pairs
    within the radius: whole, and at most one link per fingerprint and block."""
    way = way or scheme_for(nodes.count(), radius)
    keyed = nodes.select(F.col("fingerprint").alias("node"), "fingerprint", F.explode(F.array(*key_columns(F.col("fingerprint"), way))).alias("key"))
    return bucket_links(keyed, radius, joined=True)


def components(edges: DataFrame, a: str = "node", b: str = "other") -> DataFrame:
    """(node, root): the least node of each component, for nodes with links. Large-star and small-star steps in turn; a
    step's links are written to the shared folder, the step's before removed, and only counts come to the driver."""
    spark = edges.sparkSession
    links_now, path = stored_at(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "links")
    before = None
    while True:
        # large star: each node's larger neighbours get its least neighbour; small star: its smaller ones and itself do
        both = links_now.unionByName(links_now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("low"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("low").alias("v")).where("u <> v").unionByName(least.select("u", F.col("low").alias("v"))).distinct()
        links_now, next_path = stored_at(small, "links")
        remove(spark, path)
        path = next_path
        now = links_now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            return links_now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now


def labelled(nodes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """nodes (one row per fingerprint, more columns) -> with root, the least fingerprint of the component."""
    roots = components(links(nodes.select("fingerprint"), radius))
    return nodes.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))


def near_duplicates(docs: DataFrame, width: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits), component_id: the smallest doc_id that links reach.

    Texts without words (null, empty) have fingerprint 0 and link like any other; repeated rows share a fingerprint; a null
    doc_id is kept and names a component only if all its members' are null; an empty table gives no rows.
    """
    rows = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), fingerprint_column(F.col("text").cast("string"), width).alias("fingerprint")), "simhash")
    # one row per fingerprint first: a large group of copies is one node
    nodes = stored(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("least_id"), F.count(F.lit(1)).alias("members")), "simhash-nodes")
    named = labelled(nodes, radius)
    ids = named.groupBy("root").agg(F.min("least_id").alias("component_id"))
    names = named.join(ids, "root").select("fingerprint", "members", "component_id")
    # a fingerprint that a large part of the rows has is joined in slices; there are at most rows / HOT such fingerprints
    slices = F.ceil(F.col("members") / HOT).cast("int")
    hot = F.broadcast(nodes.where(F.col("members") > HOT).select("fingerprint", slices.alias("slices")))
    sliced = rows.join(hot, "fingerprint", "left").withColumn("slice", F.pmod(F.xxhash64("doc_id"), F.coalesce("slices", F.lit(1))).cast("int"))
    names = names.select("fingerprint", "component_id", F.explode(F.sequence(F.lit(0), slices - 1)).alias("slice"))
    return sliced.join(names, ["fingerprint", "slice"]).select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")
