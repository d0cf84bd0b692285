"""Small-graph metrics by joins. A graph is a table of undirected edges (src, dst); nodes without edges need a node table."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmine.functions.hashing import permuted, stable_hash
from quillmine.operators.tracking import positions
from quillmine.sources.shared import remove, stored, stored_at


def simple_edges(edges: DataFrame) -> DataFrame:
    """Each undirected edge once, src < dst, no loops."""
    return edges.where("src <> dst").select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")).distinct()


def both_ways(edges: DataFrame) -> DataFrame:
    edges = simple_edges(edges)
    return edges.unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))


def degrees(edges: DataFrame) -> DataFrame:
    return both_ways(edges).groupBy(F.col("src").alias("node")).agg(F.count(F.lit(1)).alias("degree"))


def average_degree(edges: DataFrame) -> DataFrame:
    """G1: 2E / N over nodes that have edges."""
    return degrees(edges).agg((F.sum("degree") / F.count(F.lit(1))).alias("average_degree"))


def clustering(edges: DataFrame) -> DataFrame:
    """Node, degree, triangles, coefficient. A triangle is found once: its edges lead from the node of lower degree to
    that of higher, so a node of many edges has few that lead away, and no pair of its neighbours is made that a join on
    edges does not confirm. Edges, and where they lead, are stored once, as three joins read them."""
    edges = stored(simple_edges(edges), "simple-edges")
    d = edges.select(F.explode(F.array("src", "dst")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("degree"))
    e = edges.join(d.select(F.col("node").alias("src"), F.col("degree").alias("ds")), "src").join(d.select(F.col("node").alias("dst"), F.col("degree").alias("dd")), "dst")
    up = F.struct("ds", "src") < F.struct(F.col("dd").alias("ds"), F.col("dst").alias("src"))
    led = stored(e.select(F.when(up, F.col("src")).otherwise(F.col("dst")).alias("a"), F.when(up, F.col("dst")).otherwise(F.col("src")).alias("b")), "led-edges")
    wedge = led.alias("x").join(led.select(F.col("a"), F.col("b").alias("c")).alias("y"), "a").where("b < c")
    closing = led.select(F.least("a", "b").alias("b"), F.greatest("a", "b").alias("c"))
    triangles = wedge.join(closing, ["b", "c"]).select(F.explode(F.array("a", "b", "c")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("triangles"))
    joined = d.join(triangles, "node", "left").withColumn("triangles", F.coalesce("triangles", F.lit(0).cast("long")))
    pairs = F.col("degree") * (F.col("degree") - 1)
    return joined.withColumn("coefficient", F.when(F.col("degree") < 2, 0.0).otherwise(2 * F.col("triangles") / F.nullif(pairs, F.lit(0).cast("long"))))


def pagerank_step(edges: DataFrame, ranks: DataFrame, damping: float, n: int | None = None) -> DataFrame:
    """Node, rank after one step from ranks (node, rank): damping x neighbours' rank over their degree + (1 - damping) / N.
    n: the number of nodes, if known."""
    links = both_ways(edges)
    n = ranks.count() if n is None else n
    own = ranks.join(links.groupBy(F.col("src").alias("node")).agg(F.count(F.lit(1)).alias("degree")), "node")
    given = links.join(own, F.col("src") == F.col("node")).groupBy(F.col("dst").alias("node")).agg(F.sum(F.col("rank") / F.col("degree")).alias("given"))
    return ranks.select("node").join(given, "node", "left").select("node", (F.coalesce("given", F.lit(0.0)) * damping + (1 - damping) / n).alias("rank"))


def pagerank(edges: DataFrame, damping: float = 0.8, steps: int = 1, tolerance: float | None = None, nodes: DataFrame | None = None) -> DataFrame:
    """Node, rank after at most `steps` of G3 from equal ranks; with a tolerance it ends at the first step that changes all
    ranks together by less. nodes (column node) may hold nodes without edges: what these have is spread over all nodes.

    Edges are stored once, with the degree where they lead from; a step is one join and one sum, stored, and removes the one
    before. Nothing but the change and the spread mass, a number each, comes to the driver."""
    simple = stored(simple_edges(edges), "edges")
    linked = simple.select(F.explode(F.array("src", "dst")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("degree"))
    links = stored(both_ways(simple).join(linked, F.col("src") == F.col("node")).select("src", "dst", "degree"), "links")
    nodes = stored((linked if nodes is None else nodes).select("node").distinct().join(linked, "node", "left"), "nodes")
    n = nodes.count()
    ranks, path = stored_at(nodes.select("node", F.lit(1.0 / n if n else 0.0).alias("rank")), "ranks")
    for _ in range(steps):
        given = links.join(ranks, F.col("src") == F.col("node")).groupBy(F.col("dst").alias("node")).agg(F.sum(F.col("rank") / F.col("degree")).alias("given"))
        lost = nodes.where("degree is null").join(ranks, "node").agg(F.sum("rank").alias("lost")).first().lost or 0.0
        rank = damping * (F.coalesce("given", F.lit(0.0)) + lost / max(n, 1)) + (1 - damping) / max(n, 1)
        moved, after = stored_at(ranks.withColumnRenamed("rank", "before").join(given, "node", "left").select("node", rank.alias("rank"), F.abs(rank - F.col("before")).alias("change")), "ranks")
        remove(edges.sparkSession, path)
        ranks, path = moved.select("node", "rank"), after
        if tolerance is not None and (moved.agg(F.sum("change").alias("change")).first().change or 0.0) < tolerance:
            break
    return ranks


def distances(edges: DataFrame, sources: DataFrame) -> DataFrame:
    """source, node, distance by breadth-first joins until no new node is reached: each step joins only the last step's nodes.
    The result has a row for each source and node that it reaches, so this is for small graphs or few sources."""
    links = stored(both_ways(edges), "links")
    edge_of = stored(sources.select(F.col("node").alias("source"), "node", F.lit(0).alias("distance")), "distances")
    found, step = edge_of, 0
    while not edge_of.isEmpty():
        step += 1
        reached = edge_of.join(links, F.col("node") == F.col("src")).select("source", F.col("dst").alias("node")).distinct()
        # what lies two steps back cannot be met again from here
        edge_of = stored(reached.join(found.where(F.col("distance") >= step - 2).select("source", "node"), ["source", "node"], "left_anti").withColumn("distance", F.lit(step)), "distances")
        found = found.unionByName(edge_of)
    return found


def closeness(edges: DataFrame, sources: DataFrame) -> DataFrame:
    """Node, closeness = 1 / sum of distances (of a connected graph)."""
    return distances(edges, sources).groupBy(F.col("source").alias("node")).agg((1.0 / F.nullif(F.sum("distance"), F.lit(0).cast("long"))).alias("closeness"))


def missing_edges(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Pairs u < v of nodes without an edge: what negative samples are drawn from. The result itself is of the order
    of the square of the nodes, so this is for small graphs (the only non-equi join here)."""
    pairs = nodes.select(F.col("node").alias("src")).join(nodes.select(F.col("node").alias("dst")), F.col("src") < F.col("dst"))
    return pairs.join(simple_edges(edges), ["src", "dst"], "left_anti")


def negative_sample(nodes: DataFrame, edges: DataFrame, count: int, seed: int) -> DataFrame:
    """Src < dst and draw of `count` missing edges (all, where there are fewer), each as likely as any other.

    Pairs of nodes have ranks from 0; a seeded permutation of the ranks says in which order they are drawn, so none is drawn
    twice. Drawn ranks become pairs of places and these nodes; pairs that are edges go, and more are drawn while too few are
    left. No step has more rows than nodes, edges or about count divided by the share of pairs without an edge."""
    spark = nodes.sparkSession
    places = stored(positions(nodes.select("node").distinct(), "node", name="place"), "places")
    known = simple_edges(edges).join(places.select(F.col("node").alias("src")), "src", "left_semi").join(places.select(F.col("node").alias("dst")), "dst", "left_semi")
    known = stored(known.select("src", "dst"), "known")
    n = places.count()
    pairs = n * (n - 1) // 2
    free = pairs - known.count()
    want = min(count, free)
    low, high = (places.select(F.col("place").alias(p), F.col("node").alias(c)) for p, c in (("low", "src"), ("high", "dst")))
    draws = min(pairs, math.ceil(1.1 * want * pairs / max(free, 1)) + 16) if want > 0 else 0
    while True:
        rank = permuted(F.col("id"), pairs, seed)
        drawn = spark.range(draws).select(F.col("id").alias("draw"), *pair_of(rank))
        found, path = stored_at(drawn.join(low, "low").join(high, "high").join(known, ["src", "dst"], "left_anti").select("src", "dst", "draw"), "drawn")
        if draws >= pairs or found.count() >= want:
            break
        remove(spark, path)
        draws = min(pairs, 2 * draws)
    return positions(found, "draw", name="place").where(F.col("place") < want).select("src", "dst", "draw")


def pair_of(rank: Column) -> list[Column]:
    """low < high of the pair with this rank: rank = high * (high - 1) / 2 + low. The root is put right by one either way, as
    a double holds it only nearly."""
    below = lambda h: F.shiftright(h * (h - 1), 1)
    near = F.floor((1 + F.sqrt(8 * rank.cast("double") + 1)) / 2).cast("long")
    high = F.when(below(near) > rank, near - 1).when(below(near + 1) <= rank, near + 1).otherwise(near)
    return [(rank - below(high)).alias("low"), high.alias("high")]


def can_be_negative(pairs: DataFrame, edges: DataFrame) -> DataFrame:
    """Pairs with negative: different nodes without an edge in either direction."""
    key = [F.least("src", "dst").alias("src_"), F.greatest("src", "dst").alias("dst_")]
    known = simple_edges(edges).select(F.col("src").alias("src_"), F.col("dst").alias("dst_"), F.lit(True).alias("known"))
    return pairs.select("*", *key).join(known, ["src_", "dst_"], "left").withColumn("negative", (F.col("src") != F.col("dst")) & F.col("known").isNull()).drop("src_", "dst_", "known")


def labelled_edges(positive: DataFrame, negative: DataFrame) -> DataFrame:
    """U5."""
    return reduce(DataFrame.unionByName, [p.select("src", "dst", F.lit(label).alias("label")) for p, label in ((positive, 1), (negative, 0))])


def edge_score(a: Column, b: Column) -> Column:
    """Sigmoid of the dot product."""
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y), F.lit(0.0), lambda s, x: s + x)
    return 1 / (1 + F.exp(-dot))


def accuracy(rows: DataFrame, score: str, label: str) -> DataFrame:
    """Share of rows where score > 0.5 agrees with the label, to 4 decimals."""
    hit = ((F.col(score) > 0.5).cast("int") == F.col(label)).cast("double")
    return rows.agg(F.round(F.avg(hit), 4).alias("accuracy"))


def perplexity(loss: Column) -> Column:
    """A11."""
    return F.when(loss < 50, F.exp(loss)).otherwise(F.lit(float("inf")))


def initial_embeddings(nodes: DataFrame, size: int, seed: int) -> DataFrame:
    """Node, embedding of `size` numbers from 0 to 1, even and reproducible for each node."""
    part = lambda k: (stable_hash(F.concat_ws("/", F.col("node").cast("string"), k.cast("string")), seed) % (1 << 32)).cast("double") / float(1 << 32)
    return nodes.select("node", F.transform(F.sequence(F.lit(0), F.lit(size - 1)), part).alias("embedding"))


def principal_components(rows: DataFrame, vector: str, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(centre, components as rows, each one's share of the variance). Tasks add up vectors and their products, so what
    comes to the driver is bounded by the square of the dimension; null vectors are left out. A component's largest part is
    positive, so that its direction is fixed."""
    size = rows.where(F.col(vector).isNotNull()).select(F.size(vector).alias("size")).first().size

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, gram = 0, np.zeros(size), np.zeros((size, size))
        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)
            n, total, gram = n + len(x), total + x.sum(axis=0), gram + x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([total.tolist()]), pa.array([gram.ravel().tolist()])], names=["n", "total", "gram"])

    parts = rows.where(F.col(vector).isNotNull()).select(F.col(vector).cast("array<double>")).mapInArrow(products, "n long, total array<double>, gram array<double>")
    # the parts are added up by place, which is a row for each of them, and not gathered
    sums = parts.select(F.posexplode(F.concat(F.array(F.col("n").cast("double")), "total", "gram")).alias("at", "value")).groupBy("at").agg(F.sum("value").alias("value"))
    flat = np.zeros(1 + size + size * size)
    for r in sums.collect():
        flat[r["at"]] = r["value"]
    n, centre = flat[0], flat[1 : size + 1] / flat[0]
    spread, axes = np.linalg.eigh(flat[size + 1 :].reshape(size, size) / n - np.outer(centre, centre))
    axes = axes.T[::-1][:k]
    axes = axes * np.sign(axes[np.arange(len(axes)), np.abs(axes).argmax(axis=1)])[:, None]
    return centre, axes, spread[::-1][:k] / spread.sum()


def projected(rows: DataFrame, vector: str, k: int) -> DataFrame:
    """Rows with plane, their k coordinates along the principal components."""
    centre, axes, _ = principal_components(rows, vector, k)
    along = lambda axis: F.aggregate(F.zip_with(F.col(vector), F.array(*[F.lit(float(a)) for a in axis]), lambda x, a: x.cast("double") * a), F.lit(-float(axis @ centre)), lambda s, x: s + x)
    return rows.withColumn("plane", F.when(F.col(vector).isNotNull(), F.array(*[along(axis) for axis in axes])))
