"""Homomorphic multiset hash of a text's paragraphs, with DataFrame functions alone.

A text is cut into paragraphs at line feeds, and paragraphs into pieces after sentence ends. A piece is hashed (SHA-256 under
two prefixes) to a vector of 32 lanes of 16 bits; a fingerprint is the sum of its pieces' vectors, each lane modulo 2^16, and
the count of pieces. Sums do not depend on order, and pieces can be added or taken away without the rest of the text.

Beside these lanes, which wrap and tell equal multisets from others, the first 128 bits of a hash are counted one by one,
modulo 2^32. Read as plus and minus ones, two such sums differ by a vector whose length shows how many pieces differ, whence
a likeness.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PIECE = r"[^\n.!?]+[.!?]*|[.!?]+"
HALF, LOW, LANE, LANE_LOW = 1 << 32, (1 << 32) - 1, 1 << 16, (1 << 16) - 1
GROUP, EIGHTS, BYTES = 127, 0x0101010101010101, 0x000000FF000000FF
#: Two of four lanes of a long, with room for sums of as many pieces; longs of a piece's hashes, of bit counts and of lanes.
WIDE_GROUP, EVEN = 1 << 15, 0x0000FFFF0000FFFF
LONGS, COUNTS, LANES = "abcdefgh", 64, 8
#: Buckets of neighbouring ids: cells between quantiles, cut so that a bucket holds about BUCKET_ROWS; bytes of text a task.
QUANTILES, BUCKET_ROWS, TASK_BYTES = 256, 1 << 14, 1 << 26
#: Tasks for each core at least, so that none waits long for the last one.
TASKS_A_CORE = 6


def _long(x: int) -> Column:
    return F.lit(x).cast("long")


def piece_hashes(text: Column) -> Column:
    """Per piece eight longs: SHA-256 of 0 and the piece, and of 1 and the piece."""

    def longs(x):
        hexes = F.array(F.sha2(F.concat(F.lit("0"), x).cast("binary"), 256), F.sha2(F.concat(F.lit("1"), x).cast("binary"), 256))
        part = lambda h, k: F.conv(F.substring(F.get(h, F.lit(k // 4)), 1 + 16 * (k % 4), 16), 16, -10).cast("long")
        # one item, so that the hashes are made once for all their uses
        return F.transform(F.array(hexes), lambda h: F.struct(*[part(h, k).alias(name) for k, name in enumerate(LONGS)]))[0]

    return F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(PIECE), F.lit(0)), longs)


def _grouped(hashes: Column, size: int, each) -> Column:
    """each(group of at most `size` pieces), for all of a text."""
    n = F.greatest(F.ceil(F.size(hashes) / size), F.lit(1))
    return F.transform(F.sequence(F.lit(1).cast("long"), n), lambda g: each(F.slice(hashes, ((g - 1) * size + 1).cast("int"), size)))


def lane_sums(hashes: Column) -> Column:
    """The count of pieces; 128 counts of bits, two to a long (upper and lower half); 32 lanes, four to a long.

    Bits of up to 127 pieces (a long is signed) are counted eight at a time in lanes of eight bits, then widened, so the common
    text takes 16 sums of its pieces and not 64. Lanes of 16 bits are added two at a time, with 16 bits of room each."""

    def narrow(pieces, name, j):
        return F.aggregate(pieces, _long(0), lambda s, h: s + F.shiftrightunsigned(h[name], j).bitwiseAND(_long(EIGHTS)))

    def wide(found, side, j):
        return F.aggregate(found, _long(0), lambda s, x: s + F.shiftrightunsigned(x[8 * side + j % 8], 8 * (j // 8)).bitwiseAND(_long(BYTES)))

    def lanes(pieces, name, j):
        return F.aggregate(pieces, _long(0), lambda s, h: s + F.shiftrightunsigned(h[name], 16 * j).bitwiseAND(_long(EVEN)))

    sums = _grouped(hashes, GROUP, lambda pieces: F.array(*[narrow(pieces, name, j) for name in LONGS[:2] for j in range(8)]))
    # one item, so that the sums are made once for all their uses
    counts = F.transform(F.array(sums), lambda found: F.array(*[wide(found, side, j) for side in (0, 1) for j in range(32)]))
    parts = _grouped(hashes, WIDE_GROUP, lambda pieces: F.array(*[lanes(pieces, name, j).bitwiseAND(_long(EVEN)) for name in LONGS for j in (0, 1)]))
    total = lambda found, k: F.aggregate(found, _long(0), lambda s, x: (s + x[k]).bitwiseAND(_long(EVEN)))
    joined = F.transform(F.array(parts), lambda found: F.array(*[F.shiftleft(total(found, 2 * k + 1), 16).bitwiseOR(total(found, 2 * k)) for k in range(LANES)]))
    return F.concat(F.array(F.size(hashes).cast("long")), F.get(counts, F.lit(0)), F.get(joined, F.lit(0)))


def fingerprint_text(sums: Column) -> Column:
    return F.array_join(F.transform(sums, lambda s: F.lower(F.lpad(F.hex(s), 16, "0"))), "")


def combined(a: Column, b: Column, sign: int = 1) -> Column:
    """The fingerprint of two texts' pieces together (sign 1), or of the first's without the second's (sign -1)."""

    def add(x, y, at, bits):
        low = _long((1 << bits) - 1)
        lane = lambda v: F.shiftrightunsigned(v, at).bitwiseAND(low)
        return F.shiftleft((lane(x) + sign * lane(y)).bitwiseAND(low), at)

    def sums(x, y):
        return add(x, y, 0, 32).bitwiseOR(add(x, y, 32, 32))

    def lanes(x, y):
        return add(x, y, 0, 16).bitwiseOR(add(x, y, 16, 16)).bitwiseOR(add(x, y, 32, 16)).bitwiseOR(add(x, y, 48, 16))

    at = 2 + COUNTS
    return F.concat(F.zip_with(F.slice(a, 1, at - 1), F.slice(b, 1, at - 1), sums), F.zip_with(F.slice(a, at, LANES), F.slice(b, at, LANES), lanes))


def _square_sum(sums: Column) -> Column:
    """Sum of squares of the lanes read as sums of plus and minus ones."""
    n = sums[0]
    square = lambda lane: (2 * lane - n).cast("double") * (2 * lane - n)
    return F.aggregate(F.slice(sums, 2, COUNTS), F.lit(0.0), lambda s, x: s + square(F.shiftrightunsigned(x, 32)) + square(x.bitwiseAND(_long(LOW))))


def _distance(a: Column, b: Column) -> Column:
    n = a[0] - b[0]
    square = lambda d: (2 * d - n).cast("double") * (2 * d - n)
    pair = F.zip_with(F.slice(a, 2, COUNTS), F.slice(b, 2, COUNTS), lambda x, y: square(F.shiftrightunsigned(x, 32) - F.shiftrightunsigned(y, 32)) + square(x.bitwiseAND(_long(LOW)) - y.bitwiseAND(_long(LOW))))
    return F.aggregate(pair, F.lit(0.0), lambda s, x: s + x)


def likeness(a: Column, b: Column, a_square: Column, b_square: Column) -> Column:
    """1 for equal fingerprints, about the share of common pieces else, 0 for unrelated ones."""
    near = 1.0 - _distance(a, b) / F.nullif(a_square + b_square, F.lit(0.0))
    return F.when(a == b, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(near, F.lit(0.0)))))


def with_sums(rows: DataFrame) -> DataFrame:
    """rows (text, more) with sums and square (for likeness). An empty text's sums are all zeros; equal texts have equal sums,
    and so have texts of the same pieces in another order."""
    rows = rows.withColumn("hashes", piece_hashes(F.col("text"))).withColumn("sums", lane_sums(F.col("hashes"))).drop("hashes")
    return rows.withColumn("square", _square_sum(F.col("sums")))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, text, sums and square of each document; null text counts as empty."""
    return with_sums(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")))


def bucketed(rows: DataFrame) -> tuple[DataFrame, int]:
    """rows (doc_id, text, tie) with bucket, which rises with doc_id (nulls below all) and, among rows of one id, falls with
    tie; and how many tasks their text makes.

    Cells lie between quantiles of doc_id. An id that more rows have than a quantile holds (at most QUANTILES of them) is a
    cell of its own, as is null; such a cell is cut by ranges of tie, the others by ranges of doc_id."""
    ids = rows.select("doc_id", F.octet_length("text").alias("bytes"))
    n, size, bounds, least, most = ids.agg(F.count(F.lit(1)), F.sum("bytes"), F.approx_percentile("doc_id", [k / QUANTILES for k in range(1, QUANTILES)], 10_000), F.min("doc_id"), F.max("doc_id")).first()
    common = {r.doc_id for r in ids.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > max(BUCKET_ROWS, n // QUANTILES)).collect()} - {None}
    bounds = sorted(({least, *(bounds or [])} | common | {x + 1 for x in common if x < (1 << 63) - 1}) - {None})
    parts = max(1, -(-n // BUCKET_ROWS))  # of a cell that may hold all rows
    per_cell = max(1, -(-n // max(1, len(bounds)) // BUCKET_ROWS))
    widths = [max(1, -(-(end - low) // per_cell)) for low, end in zip(bounds, [*bounds[1:], (most or 0) + 1])]
    starts, widths = (F.array(*map(_long, x)) if x else F.array().cast("array<long>") for x in (bounds, widths))
    alone = F.col("doc_id").isNull() | F.col("doc_id").isin(*common) if common else F.col("doc_id").isNull()
    cell = F.when(F.col("doc_id").isNull(), F.lit(0)).otherwise(F.size(F.filter(starts, lambda b: b <= F.col("doc_id"))))
    by_id = F.least(_long(per_cell - 1), F.floor((F.col("doc_id") - F.get(starts, F.col("cell") - 1)) / F.get(widths, F.col("cell") - 1)))
    by_tie = _long(parts - 1) - F.least(_long(parts - 1), F.floor((F.col("tie") / F.lit(2.0**64) + 0.5) * parts))
    part = F.when(alone, by_tie).otherwise(F.coalesce(by_id, _long(0)))
    rows = rows.withColumn("cell", cell.cast("long")).withColumn("bucket", F.col("cell") * max(parts, per_cell) + part).drop("cell")
    return rows, max(-(-(size or 0) // TASK_BYTES), TASKS_A_CORE * rows.sparkSession.sparkContext.defaultParallelism)


def with_next(rows: DataFrame, carried: list[str], prepare=lambda rows: rows) -> DataFrame:
    """prepare(rows) with next_<c> for each carried column: that of the next row by descending doc_id (nulls last) and rising
    tie, the first row's after the last. rows: doc_id, text, tie. prepare runs where rows have moved to.

    Rows are dealt into buckets of neighbours; the first row of each bucket also goes to the end of the bucket before it. So
    the rows move once, and no task needs more than a bucket at a time."""
    dealt, n_tasks = bucketed(rows)
    firsts = dealt.groupBy("bucket").agg(F.max_by(F.struct("doc_id", "tie"), F.struct(F.col("doc_id"), -(F.col("tie").cast("decimal(20,0)")))).alias("first"))
    descending, everything = Window.orderBy(F.col("bucket").desc()), Window.partitionBy()
    # one row per bucket: at most rows / BUCKET_ROWS and two for each cell
    before = F.coalesce(F.lag("bucket").over(descending), F.min("bucket").over(everything))
    both = dealt.join(F.broadcast(firsts.withColumn("before", before)), "bucket")
    own = F.struct(F.col("bucket").alias("bucket"), F.lit(0).alias("ghost"))
    ghost = F.struct(F.col("before").alias("bucket"), F.lit(1).alias("ghost"))
    leads = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("tie") == F.col("first.tie"))
    both = both.withColumn("in", F.explode(F.when(leads, F.array(own, ghost)).otherwise(F.array(own))))
    both = prepare(both.select(F.col("in.bucket").alias("bucket"), F.col("in.ghost").alias("ghost"), *rows.columns).repartition(n_tasks, "bucket"))
    order = Window.partitionBy("bucket").orderBy("ghost", F.col("doc_id").desc_nulls_last(), "tie")
    kept = [c for c in both.columns if c not in ("bucket", "ghost")]
    following = F.lead(F.struct(*carried)).over(order)
    return both.withColumn("following", following).where("ghost = 0").select(*kept, *[F.col("following")[c].alias(f"next_{c}") for c in carried])


def compared(docs: DataFrame) -> DataFrame:
    """Each document's fingerprint beside that of its edited text (its last third replaced by the start of the next
    document, by descending doc_id) and its likeness to that and to the next document's.

    Null and empty texts: n_chars 0, nothing to replace. A null doc_id comes last; rows with one doc_id are ordered by a
    hash of their text; a single document is its own next; an empty table gives no rows; other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text")).withColumn("row_id", F.monotonically_increasing_id())
    # of equal rows that would fill a bucket all but one have an equal row next; there is at most one such row for each bucket
    often = rows.groupBy("doc_id", "tie").agg(F.count(F.lit(1)).alias("n"), F.min("row_id").alias("kept")).where(F.col("n") > BUCKET_ROWS)
    often = F.broadcast(often.select(F.col("doc_id").alias("often_id"), F.col("tie").alias("often_tie"), "kept"))
    rows = rows.join(often, F.col("doc_id").eqNullSafe(F.col("often_id")) & (F.col("tie") == F.col("often_tie")), "left")
    repeats, carried = F.coalesce(F.col("row_id") != F.col("kept"), F.lit(False)), ["text", "sums", "square"]
    same = with_sums(rows.where(repeats).select("doc_id", "text", "tie"))
    same = same.select("*", *[F.col(c).alias(f"next_{c}") for c in carried])
    rows = with_next(rows.where(~repeats).select("doc_id", "text", "tie"), carried, with_sums).unionByName(same)
    rows = rows.withColumn("n_chars", F.length("text").cast("long")).withColumn("cut", F.floor(F.col("n_chars") / 3).cast("int"))
    edited = F.concat(F.substring("text", F.lit(1), (F.col("n_chars") - F.col("cut")).cast("int")), F.substring("next_text", F.lit(1), F.col("cut")))
    rows = rows.withColumn("edited", edited).drop("text", "next_text")
    rows = rows.withColumn("edited_hashes", piece_hashes(F.col("edited"))).withColumn("edited_sha256", F.sha2(F.col("edited").cast("binary"), 256)).drop("edited")
    rows = rows.withColumn("edited_sums", lane_sums(F.col("edited_hashes"))).drop("edited_hashes").withColumn("edited_square", _square_sum(F.col("edited_sums")))
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", fingerprint_text(F.col("sums")).alias("fingerprint"), fingerprint_text(F.col("edited_sums")).alias("edited_fingerprint"),
        likeness(F.col("sums"), F.col("edited_sums"), F.col("square"), F.col("edited_square")).alias("near_edited"),
        likeness(F.col("sums"), F.col("next_sums"), F.col("square"), F.col("next_square")).alias("near_next"),
    )


def compared_sql() -> str:
    """compared() in SQL, over the table documents."""
    bits = [(f"sum((w{2 * side} >> {j}) & 1)", f"sum((w{2 * side + 1} >> {j}) & 1)") for side in (0, 1) for j in range(32)]
    digits = " || ".join(f"printf('%08x', coalesce({x}, 0)::BIGINT)" for pair in bits for x in pair)
    lanes = " || ".join(f"printf('%04x', (coalesce(sum(v{k}), 0) % 65536)::BIGINT)" for k in range(32))
    listed = ", ".join(f"coalesce({x}, 0)::DOUBLE" for pair in bits for x in pair)
    words = ", ".join(f"('0x' || substr(h, {1 + 8 * k}, 8))::UBIGINT AS w{k}" for k in range(4))
    words += ", " + ", ".join(f"('0x' || substr({'gh'[k < 16]}, {1 + 4 * (k % 16)}, 4))::UBIGINT AS v{k}" for k in range(32))
    square = "list_sum(list_transform({a}.lanes, lambda v: (2 * v - {a}.n) * (2 * v - {a}.n)))"
    apart = "list_sum(list_transform(list_zip({a}.lanes, {b}.lanes), lambda v: (2 * (v[1] - v[2]) - ({a}.n - {b}.n)) * (2 * (v[1] - v[2]) - ({a}.n - {b}.n))))"

    def near(a: str, b: str) -> str:
        return f"CASE WHEN {a}.fp = {b}.fp THEN 1.0::DOUBLE ELSE greatest(0.0::DOUBLE, least(1.0::DOUBLE, coalesce(1.0::DOUBLE - {apart.format(a=a, b=b)} / nullif({square.format(a=a)} + {square.format(a=b)}, 0), 0.0))) END"

    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
n AS (SELECT doc_id, text, coalesce(lead(text) OVER (ORDER BY doc_id DESC), first_value(text) OVER (ORDER BY doc_id DESC)) AS following FROM d),
e AS (SELECT *, length(text)::BIGINT AS n_chars, substr(text, 1, length(text) - length(text) // 3) || substr(following, 1, length(text) // 3) AS edited FROM n),
t AS (SELECT text FROM e UNION SELECT edited FROM e),
p AS (SELECT text, {words} FROM (SELECT text, sha256('0' || piece) AS h, sha256('1' || piece) AS g FROM (SELECT text, unnest(regexp_extract_all(text, '{PIECE}')) AS piece FROM t))),
f AS (SELECT t.text, count(w0)::DOUBLE AS n, printf('%016x', count(w0)) || {digits} || {lanes} AS fp, [{listed}] AS lanes FROM t LEFT JOIN p ON t.text = p.text GROUP BY t.text)
SELECT e.doc_id, e.n_chars, sha256(e.edited) AS edited_sha256, a.fp AS fingerprint, b.fp AS edited_fingerprint, {near('a', 'b')} AS near_edited, {near('a', 'c')} AS near_next
FROM e JOIN f a ON a.text = e.text JOIN f b ON b.text = e.edited JOIN f c ON c.text = e.following"""
