"""Queries of graph metrics, embeddings and series."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quillmine.functions.hashing import permuted_sql
from quillmine.operators import graph, tracking
from quillmine.plans.corpus import table
from quillmine.sources.shared import stored

QUERIES, ORACLE_SQL = {}, {}

#: Nations as nodes; an edge where more line items than on average go from suppliers of one to customers of the other.
EDGES_SQL = """
w AS (SELECT least(c_nationkey, s_nationkey)::BIGINT AS src, greatest(c_nationkey, s_nationkey)::BIGINT AS dst, count(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey WHERE c_nationkey <> s_nationkey GROUP BY 1, 2),
e AS (SELECT src, dst FROM w WHERE n > (SELECT avg(n) FROM w)), b AS (SELECT src, dst FROM e UNION ALL SELECT dst, src FROM e), d AS (SELECT src AS node, count(*) AS degree FROM b GROUP BY 1)"""


def query(name: str, sql: str | None = None):
    def register(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLE_SQL[name] = sql
        return f

    return register


def trade_edges(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    lines = lines.join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")).where("c_nationkey <> s_nationkey")
    pair = [F.least("c_nationkey", "s_nationkey").cast("long").alias("src"), F.greatest("c_nationkey", "s_nationkey").cast("long").alias("dst")]
    weights = lines.groupBy(*pair).agg(F.count(F.lit(1)).alias("n"))
    return weights.crossJoin(F.broadcast(weights.agg(F.avg("n").alias("mean")))).where("n > mean").select("src", "dst")


@query("graph_edges", f"WITH {EDGES_SQL} SELECT src, dst FROM e")
def graph_edges(spark, sf_dir):
    return graph.simple_edges(trade_edges(spark, sf_dir))


@query("graph_degree", f"WITH {EDGES_SQL} SELECT round(sum(degree)::DOUBLE / count(*), 9) AS average_degree FROM d")
def graph_degree(spark, sf_dir):
    return graph.average_degree(trade_edges(spark, sf_dir)).select(F.round("average_degree", 9).alias("average_degree"))


@query("graph_clustering", f"""WITH {EDGES_SQL}, t AS (SELECT x.src AS node, count(*) AS twice FROM b x JOIN b y ON x.src = y.src AND x.dst <> y.dst JOIN b z ON z.src = x.dst AND z.dst = y.dst GROUP BY 1)
SELECT d.node, degree, coalesce(twice, 0) // 2 AS triangles, round(CASE WHEN degree < 2 THEN 0 ELSE coalesce(twice, 0)::DOUBLE / (degree * (degree - 1)) END, 9) AS coefficient FROM d LEFT JOIN t ON d.node = t.node""")
def graph_clustering(spark, sf_dir):
    return graph.clustering(stored(trade_edges(spark, sf_dir), "edges")).select("node", "degree", "triangles", F.round("coefficient", 9).alias("coefficient"))


@query("graph_pagerank_step", f"""WITH {EDGES_SQL}, n AS (SELECT count(*) AS n FROM d)
SELECT b.dst AS node, round(sum(0.8 * (1.0::DOUBLE / n.n) / d.degree) + 0.2 / max(n.n), 9) AS rank FROM b JOIN d ON b.src = d.node CROSS JOIN n GROUP BY 1""")
def graph_pagerank_step(spark, sf_dir):
    return graph.pagerank(trade_edges(spark, sf_dir), 0.8, 1).select("node", F.round("rank", 9).alias("rank"))


RANK_STEPS = 40


@query("graph_pagerank", f"""WITH RECURSIVE {EDGES_SQL}, m AS (SELECT n_nationkey::BIGINT AS node FROM nation), n AS (SELECT count(*)::DOUBLE AS n FROM m),
r AS (SELECT 0 AS step, node, 1 / n AS rank FROM m, n UNION ALL
  SELECT s.step + 1, m.node, 0.8::DOUBLE * (coalesce(g.given, 0) + coalesce(s.lost, 0) / n) + 0.2::DOUBLE / n
  FROM m CROSS JOIN n CROSS JOIN (SELECT max(step) AS step, sum(CASE WHEN degree IS NULL THEN rank END) AS lost FROM r LEFT JOIN d ON d.node = r.node) s
  LEFT JOIN (SELECT b.dst, sum(r.rank / d.degree) AS given FROM r JOIN b ON b.src = r.node JOIN d ON d.node = r.node GROUP BY 1) g ON g.dst = m.node WHERE s.step < {RANK_STEPS})
SELECT node, round(rank, 9) AS rank FROM r WHERE step = {RANK_STEPS}""")
def graph_pagerank(spark, sf_dir):
    """G4 until ranks stand still; nations without an edge spread theirs."""
    nodes = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("node"))
    return graph.pagerank(trade_edges(spark, sf_dir), 0.8, 100, 1e-11, nodes).select("node", F.round("rank", 9).alias("rank"))


@query("negative_sample", f"""WITH {EDGES_SQL}, i AS (SELECT node, row_number() OVER (ORDER BY node) - 1 AS i FROM d), p AS (SELECT (count(*) * (count(*) - 1)) // 2 AS p FROM d),
q AS (SELECT (y.i * (y.i - 1)) // 2 + x.i AS r, x.node AS src, y.node AS dst FROM i x JOIN i y ON x.i < y.i),
k AS (SELECT k AS draw, {permuted_sql('k', 'p', 7)} AS r FROM p, LATERAL (SELECT unnest(range(p)) AS k))
SELECT src, dst, draw FROM k JOIN q USING (r) WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.src = q.src AND e.dst = q.dst) ORDER BY draw LIMIT 60""")
def negative_sample(spark, sf_dir):
    """As many pairs without an edge as asked for, without making all of them."""
    edges = stored(trade_edges(spark, sf_dir), "edges")
    return graph.negative_sample(graph.degrees(edges).select("node"), edges, 60, 7)


@query("embedding_plane")
def embedding_plane(spark, sf_dir):
    """Embeddings along their two principal components."""
    rows = graph.projected(table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding"), "embedding", 2)
    return rows.select("vec_id", "label", F.round(F.col("plane")[0], 6).alias("x"), F.round(F.col("plane")[1], 6).alias("y"))


@query("initial_embeddings", """
SELECT c_custkey AS node, k, ((('0x' || substr(sha256('5:' || c_custkey || '/' || k), 1, 16))::UBIGINT % 4294967296)::DOUBLE / 4294967296) AS value FROM customer, (SELECT unnest(range(8)) AS k)""")
def initial_embeddings(spark, sf_dir):
    """Where a node's vector starts."""
    nodes = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("node"))
    return graph.initial_embeddings(nodes, 8, 5).select("node", F.posexplode("embedding").alias("k", "value")).withColumn("k", F.col("k").cast("long"))


@query("graph_closeness", f"""WITH RECURSIVE {EDGES_SQL},
r AS (SELECT node AS source, node, 0 AS distance FROM d UNION SELECT r.source, b.dst, r.distance + 1 FROM r JOIN b ON r.node = b.src WHERE r.distance < 24),
m AS (SELECT source, node, min(distance) AS distance FROM r GROUP BY 1, 2) SELECT source AS node, round(1.0::DOUBLE / nullif(sum(distance), 0), 9) AS closeness FROM m GROUP BY 1""")
def graph_closeness(spark, sf_dir):
    edges = stored(trade_edges(spark, sf_dir), "edges")
    return graph.closeness(edges, graph.degrees(edges).select("node")).select("node", F.round("closeness", 9).alias("closeness"))


@query("negative_edges", f"WITH {EDGES_SQL} SELECT x.node AS src, y.node AS dst FROM d x JOIN d y ON x.node < y.node WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.src = x.node AND e.dst = y.node)")
def negative_edges(spark, sf_dir):
    edges = trade_edges(spark, sf_dir)
    return graph.missing_edges(graph.degrees(edges).select("node"), edges)


@query("negative_edge_test", f"WITH {EDGES_SQL} SELECT n_nationkey::BIGINT AS src, n_regionkey::BIGINT AS dst, n_nationkey <> n_regionkey AND NOT EXISTS (SELECT 1 FROM b WHERE b.src = n_nationkey AND b.dst = n_regionkey) AS negative FROM nation")
def negative_edge_test(spark, sf_dir):
    pairs = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("src"), F.col("n_regionkey").cast("long").alias("dst"))
    return graph.can_be_negative(pairs, trade_edges(spark, sf_dir))


SCORE_SQL = "1 / (1 + exp(-list_sum(list_transform(list_zip(a.embedding, b.embedding), lambda p: p[1]::DOUBLE * p[2]))))"


def _pairs(spark, sf_dir):
    v = table(spark, sf_dir, "embeddings")
    other = v.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("next"), F.col("label").alias("next_label"))
    rows = v.join(other, "vec_id")
    return rows.select("vec_id", graph.edge_score(F.col("embedding"), F.col("next")).alias("score"), (F.col("label") == F.col("next_label")).cast("int").alias("same"))


@query("embedding_edge_score", f"SELECT a.vec_id, round({SCORE_SQL}, 6) AS score FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1")
def embedding_edge_score(spark, sf_dir):
    return _pairs(spark, sf_dir).select("vec_id", F.round("score", 6).alias("score"))


@query("embedding_accuracy", f"SELECT round(avg((({SCORE_SQL} > 0.5) = (a.label = b.label))::INTEGER), 4) AS accuracy FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1")
def embedding_accuracy(spark, sf_dir):
    return graph.accuracy(_pairs(spark, sf_dir), "score", "same")


@query("labelled_edges", f"WITH {EDGES_SQL} SELECT src, dst, 1 AS label FROM e UNION ALL SELECT x.node, y.node, 0 FROM d x JOIN d y ON x.node < y.node WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.src = x.node AND e.dst = y.node)")
def labelled_edges(spark, sf_dir):
    edges = stored(trade_edges(spark, sf_dir), "edges")
    return graph.labelled_edges(edges, graph.missing_edges(graph.degrees(edges).select("node"), edges))


@query("perplexity", "SELECT event_id, CASE WHEN value / 10 < 50 THEN round(exp(value / 10) / exp(floor(value / 10)), 6) ELSE 'inf'::DOUBLE END AS scaled_perplexity FROM events")
def perplexity(spark, sf_dir):
    p = graph.perplexity(F.col("value") / 10)
    below = F.exp(F.floor(F.col("value") / 10))
    # far below zero both are zero, or this one is; what is over zero is so by IEEE's rules, as in the SQL
    over_zero = F.when(p == 0, F.lit(float("nan"))).otherwise(F.lit(float("inf")))
    scaled = F.when(below == 0, over_zero).otherwise(F.round(F.try_divide(p, below), 6))
    return table(spark, sf_dir, "events").select("event_id", F.when(p == float("inf"), p).otherwise(scaled).alias("scaled_perplexity"))


YEARS_SQL = """y AS (SELECT o_orderpriority AS measure, o_orderstatus AS court, year(o_orderdate)::INTEGER AS year, count(*) AS n FROM orders GROUP BY 1, 2, 3),
pairs AS (SELECT measure, court, year, lag(n) OVER w AS before, n FROM y WINDOW w AS (PARTITION BY measure, court ORDER BY year))"""


@query("court_series", f"""WITH {YEARS_SQL}, s AS (SELECT measure, court, year - 1 AS year, before AS value FROM (SELECT *, row_number() OVER (PARTITION BY measure, court ORDER BY year) AS k FROM pairs WHERE before IS NOT NULL) WHERE k = 1
  UNION ALL SELECT measure, court, year, n FROM pairs WHERE before IS NOT NULL)
SELECT measure, year, sum(value) FILTER (WHERE court = 'F')::BIGINT AS local, sum(value) FILTER (WHERE court = 'O')::BIGINT AS appeal, sum(value)::BIGINT AS stacked FROM s GROUP BY 1, 2""")
def court_series(spark, sf_dir):
    """A14 over orders: each year has its own count beside that of the year before, and a series is made of the pairs."""
    years = table(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("measure"), F.col("o_orderstatus").alias("court"), F.year("o_orderdate").alias("year")).agg(F.count(F.lit(1)).alias("n"))
    pairs = years.withColumn("before", F.lag("n").over(Window.partitionBy("measure", "court").orderBy("year"))).where("before is not null")
    rows = tracking.series(pairs, ["measure", "court"], "year", "before", "n")
    of = lambda c: F.sum(F.when(F.col("court") == c, F.col("value")))
    return rows.groupBy("measure", "year").agg(of("F").alias("local"), of("O").alias("appeal"), F.sum("value").alias("stacked"))
