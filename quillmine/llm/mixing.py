"""Mixing sources to target weights, with DataFrame functions alone.

Each source's words, laid end to end in a fixed order, are packed into blocks of one length. A source gets as many slots
as its target holds blocks. A pseudorandom permutation of all slots deals them out over output shards, so that a shard's
counts of sources are a multinomial draw under the condition that the sources' totals come out exactly (drawn without
replacement); within a source, slots go through a permutation of block indices, one for each pass over the source, and
blocks are joined by index. The mix comes out in that order: shards whole, their slots by place, a slot's pieces as in its
block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmine.llm.common import WORD, row_columns, row_struct, stored

BLOCK_WORDS = 1024
SHARD_SLOTS = 256
SHARE = 1.5
MOST_REPEATS = 2
WEIGHTS = (5, 2, 1)
#: Rows that one task puts in order; the number of buckets follows the table.
BUCKET_ROWS = 1 << 11
#: Slots that one row stands for before it is spread over tasks, and slots of a task.
RUN_SLOTS, TASK_SLOTS = 1 << 12, 1 << 16
#: Slots whose texts a task puts in order.
TASK_SHARD_SLOTS = 1 << 12
ROUNDS = 24


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def permuted(x: Column, n: Column, *key: Column) -> Column:
    """x's place in a pseudorandom permutation of 0..n-1 that the key picks (swap-or-not shuffle): in each round x and
    its mirror image about a keyed pivot trade places or not, by a keyed bit of the larger of the two."""

    def step(at, k):
        mirror = F.pmod(F.pmod(F.xxhash64(F.lit("pivot"), k, *key), n) - at, n)
        swap = F.xxhash64(F.lit("bit"), k, F.greatest(at, mirror), *key).bitwiseAND(F.lit(1)) == 1
        return F.when(swap, mirror).otherwise(at)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), x.cast("long"), step)


def targets(source_sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most_repeats: int = MOST_REPEATS) -> DataFrame:
    """(source, source_size) -> also source_id (rank by code point, null last), weight and target.

    A source's target is its weight times one level, but at most most_repeats times its size; sources in the order in
    which a rising level reaches their limits give that level in closed form: the same as sharing the excess anew until
    no source is above its limit. There is one row per source, so one task puts them in order.
    """
    by_name, everything = Window.orderBy(F.col("source").asc_nulls_last()), Window.partitionBy()
    ranked = source_sizes.withColumn("source_id", F.row_number().over(by_name).cast("long"))
    ranked = ranked.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), ((F.col("source_id") - 1) % len(weights) + 1).cast("int")).cast("double"))
    ranked = ranked.withColumn("most", F.col("source_size") * F.lit(float(most_repeats)))
    filling = Window.orderBy(F.col("most") / F.col("weight"), "source_id")
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(everything) * F.lit(share) - F.coalesce(F.sum("most").over(before), F.lit(0.0))
    weight_left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    ranked = ranked.withColumn("full", F.col("most") * weight_left <= left * F.col("weight"))
    spare = F.sum("source_size").over(everything) * F.lit(share) - F.coalesce(F.sum(F.when(F.col("full"), F.col("most"))).over(everything), F.lit(0.0))
    spare_weight = F.sum(F.when(~F.col("full"), F.col("weight"))).over(everything)
    return ranked.withColumn("target", F.when(F.col("full"), F.col("most")).otherwise(spare / spare_weight * F.col("weight"))).select("source", "source_id", "source_size", "weight", "target")


def slots(sources: DataFrame, block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """One row per slot of the mix: source_id, pass (0, 1, ...), block, words (taken from the block's start), shard, place."""
    wanted = F.round("target").cast("long")
    blocks = F.ceil(F.col("source_size") / block_words)
    dealt = sources.where((F.col("source_size") > 0) & (F.col("target") > 0)).withColumn("wanted", wanted)
    dealt = dealt.withColumn("block_words", F.ceil(F.col("source_size") / blocks)).withColumn("blocks", F.ceil(F.col("source_size") / F.col("block_words")))
    whole = F.floor(F.col("wanted") / F.col("source_size")) * F.col("blocks") + F.floor(F.pmod("wanted", "source_size") / F.col("block_words"))
    dealt = dealt.withColumn("whole", whole).withColumn("rest", F.pmod(F.pmod("wanted", "source_size"), F.col("block_words")))
    dealt = dealt.withColumn("n_slots", F.col("whole") + (F.col("rest") > 0).cast("long")).where("n_slots > 0")
    in_order = Window.orderBy("source_id")
    dealt = dealt.withColumn("first_slot", F.sum("n_slots").over(in_order) - F.col("n_slots")).withColumn("all_slots", F.sum("n_slots").over(Window.partitionBy()))
    # a fixed number of tasks: by the bytes of these few rows they would all be put into one
    n_tasks = -(-int(dealt.agg(F.sum("n_slots")).first()[0] or 1) // TASK_SLOTS)
    runs = dealt.withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n_slots") - 1) / RUN_SLOTS)))).repartition(n_tasks, "source_id", "run")
    last = F.least(F.col("n_slots"), (F.col("run") + 1) * RUN_SLOTS) - 1
    each = runs.withColumn("slot", F.explode(F.sequence(F.col("run") * RUN_SLOTS, last)))
    each = each.withColumn("pass", F.floor(F.col("slot") / F.col("blocks")))
    each = each.withColumn("block", permuted(F.pmod("slot", "blocks"), F.col("blocks"), F.col("source_id"), F.col("pass")))
    each = each.withColumn("out", permuted(F.col("first_slot") + F.col("slot"), F.col("all_slots"), F.lit("shards")))
    length = F.least(F.col("block_words"), F.col("source_size") - F.col("block") * F.col("block_words"))
    return each.select(
        "source_id", "pass", "block", F.when(F.col("slot") < F.col("whole"), length).otherwise(F.least(length, F.col("rest"))).alias("words"),
        F.floor(F.col("out") / shard_slots).alias("shard"), F.pmod(F.col("out"), F.lit(shard_slots)).alias("place"),
    )


def mixture(docs: DataFrame, row_id: str | None = None, block_words: int = BLOCK_WORDS, weights=WEIGHTS, share: float = SHARE, most_repeats: int = MOST_REPEATS, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """What the mix takes of each document: doc_id, source, size, source_size, target, taken (words, repeats counted), takes
    (array of pass, first, last, shard, place, at: the document's words first..last-1 are taken in that pass, for the slot
    at that place of the shard, in which they begin at word `at`), and row_id, if that column is named.

    Null text has size 0 and is never taken; a null source is a source of its own, the last one; documents with a null
    doc_id take part; equal rows each count, and which of them gives which words is of no consequence as they are equal;
    an empty table gives no rows; other columns are ignored. Reruns over the same rows agree. Sources are ordered in one
    task, a row for each.
    """
    own = [F.col(row_id).alias("row_id")] if row_id else []
    sizes = docs.select(*own, F.xxhash64("doc_id", "source", "text").alias("row_key"), F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size"))
    sizes = stored(sizes.withColumn("spread", F.monotonically_increasing_id()), "sizes")
    n_buckets = max(1, -(-sizes.count() // BUCKET_ROWS))
    # equal rows that would fill a bucket are dealt over all; there are at most four for each bucket
    often = sizes.groupBy("row_key", "doc_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > BUCKET_ROWS // 4)
    often = F.broadcast(often.select(F.col("row_key").alias("often"), F.col("doc_id").alias("often_id")))
    sizes = sizes.join(often, (F.col("row_key") == F.col("often")) & F.col("doc_id").eqNullSafe(F.col("often_id")), "left")
    bucket = F.xxhash64("row_key", "doc_id", F.when(F.col("often").isNotNull(), F.col("spread")).otherwise(F.lit(0).cast("long")))
    sizes = sizes.withColumn("bucket", F.pmod(bucket, F.lit(n_buckets))).drop("often", "often_id")
    totals = sizes.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    sources = stored(targets(totals.groupBy("source").agg(F.sum("bucket_size").alias("source_size")), weights, share, most_repeats), "sources")
    # offsets in two steps: buckets within a source (one row per bucket), then documents within a bucket
    ids = ["row_id"] if row_id else []
    in_bucket = Window.partitionBy("source", "bucket").orderBy("row_key", "doc_id", *ids).rowsBetween(Window.unboundedPreceding, 0)
    bases = totals.withColumn("base", F.sum("bucket_size").over(Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)) - F.col("bucket_size"))
    same = lambda a, b, *names: [a[n].eqNullSafe(b[n]) for n in names]
    placed = sizes.withColumn("within", F.sum("size").over(in_bucket) - F.col("size"))
    placed = placed.join(bases, same(placed, bases, "source", "bucket")).select(placed["*"], (bases["base"] + placed["within"]).alias("start"))
    placed = placed.join(sources, same(placed, sources, "source")).select(placed["*"], sources["source_id"], sources["source_size"], sources["target"])
    placed = placed.withColumn("block_words", F.ceil(F.col("source_size") / F.ceil(F.col("source_size") / block_words)))
    used = slots(sources, block_words, shard_slots).groupBy("source_id", "block").agg(
        *[F.sum(F.when(F.col("pass") == p, F.col("words")).otherwise(0)).alias(f"pass{p}") for p in range(most_repeats)],
        *[F.max(F.when(F.col("pass") == p, F.struct("shard", "place"))).alias(f"slot{p}") for p in range(most_repeats)],
    )
    touched = placed.where("size > 0").withColumn("block", F.explode(F.sequence(F.floor(F.col("start") / F.col("block_words")), F.floor((F.col("start") + F.col("size") - 1) / F.col("block_words")))))
    touched = touched.join(used, ["source_id", "block"], "left")
    begin = F.col("block") * F.col("block_words")

    def take(p):
        low = F.greatest(begin, F.col("start")) - F.col("start")
        high = F.least(begin + F.coalesce(F.col(f"pass{p}"), F.lit(0)), F.col("start") + F.col("size")) - F.col("start")
        at = F.greatest(begin, F.col("start")) - begin
        return F.struct(F.lit(p).alias("pass"), low.alias("first"), high.alias("last"), F.col(f"slot{p}.shard").alias("shard"), F.col(f"slot{p}.place").alias("place"), at.alias("at"))

    takes = F.filter(F.array(*map(take, range(most_repeats))), lambda x: x["last"] > x["first"])
    touched = touched.withColumn("takes", takes).withColumn("took", F.aggregate("takes", F.lit(0).cast("long"), lambda a, x: a + x["last"] - x["first"]))
    per_doc = [*ids, "row_key", "doc_id", "source", "size", "source_size", "target"]
    summed = touched.groupBy("source_id", "start", *per_doc).agg(F.sum("took").alias("taken"), F.array_sort(F.flatten(F.collect_list("takes"))).alias("takes"))
    nothing = placed.where("size = 0").select(*per_doc, F.lit(0).cast("long").alias("taken"), F.array().cast(summed.schema["takes"].dataType).alias("takes"))
    return summed.select(*nothing.columns).unionByName(nothing).drop("row_key")


def slot_text(takes: Column) -> Column:
    """The slots that a document is in, `shard:place`, comma-joined in order."""
    return F.array_join(F.transform(F.array_sort(F.transform(takes, lambda x: F.struct(x["shard"].alias("shard"), x["place"].alias("place")))), lambda x: F.concat_ws(":", x["shard"].cast("string"), x["place"].cast("string"))), ",")


def dealt(docs: DataFrame, shard_slots: int = SHARD_SLOTS, **parameters) -> DataFrame:
    """The mix with shard, place and at: a row per document and slot that takes words of it, with the document's columns, its
    text cut to the words taken (white space after a word stays with it) and n_chars set anew where that column exists.
    Each shard is in one partition, in order. Rows are numbered and stored first, so a row is cut by its own takes whatever
    its columns hold."""
    columns = docs.columns
    rows = stored(docs.select(row_struct(columns), F.monotonically_increasing_id().alias("row_id")), "mixing-rows")
    plan = mixture(rows.select("row_id", "row.doc_id", "row.source", "row.text"), "row_id", shard_slots=shard_slots, **parameters)
    plan = stored(plan.where("taken > 0").select("row_id", "takes"), "mixing-plan")
    last = plan.agg(F.max(F.array_max(F.transform("takes", lambda x: x["shard"])))).first()[0]
    rows = rows.join(plan, "row_id").withColumn("words", F.regexp_extract_all(F.col("row").getField("text"), F.lit(WORD + r"[\x20\x09-\x0D]*"), F.lit(0)))
    # cut before they are spread: a long text is not repeated for each of its pieces
    cut = F.transform("takes", lambda x: F.struct(x["shard"].alias("shard"), x["place"].alias("place"), x["at"].alias("at"), F.array_join(F.slice("words", x["first"].cast("int") + 1, (x["last"] - x["first"]).cast("int")), "").alias("text")))
    kept = [c for c in columns if c not in ("text", "n_chars")]
    rows = rows.select(F.struct(F.lit(0).alias("_"), *row_columns(kept)).alias("row"), F.explode(cut).alias("piece"))
    new = {"text": F.col("piece.text"), "n_chars": F.length("piece.text").cast(docs.schema["n_chars"].dataType) if "n_chars" in columns else None}
    rows = rows.select(F.struct(*[new[c].alias(c) if c in new else row_columns([c])[0] for c in columns]).alias("row"), "piece.shard", "piece.place", "piece.at")
    n_tasks = -(-((last or 0) + 1) * shard_slots // TASK_SHARD_SLOTS)
    return rows.repartition(n_tasks, "shard").sortWithinPartitions("shard", "place", "at")


def mixed(docs: DataFrame, **parameters) -> DataFrame:
    """The mix itself, as dealt() orders it, with the documents' columns: a row per document and slot. Documents with a null or
    empty text are in no slot; a null source is one of its own; repeated rows each count; an empty table gives no rows; other
    columns may have any names and are kept."""
    return dealt(docs, **parameters).select(*row_columns(docs.columns))
