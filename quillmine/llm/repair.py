"""Conversation structure repair: the cheapest edits after which roles read `(s?(ua)+)?`, by a fold over sorted turns.

A turn's fault comes from windows: blank, a duplicate of an earlier turn, or cut off before its last sentence's end. The
fold carries four (cost, audit) structs, one for each state that role initials can be in (nothing yet, after s, after u,
after a), and takes the least of what keeping, changing, deleting or inserting leads to. Audits of equal cost differ before
either ends, since a longer one would cost more, so the least struct stays the least whatever follows.

Conversations have no bound in length. Turns travel without their texts (a digest stands for them), in ranges of equal size,
so a conversation that holds a third of all rows is spread over a third of the ranges. A block of at most BLOCK turns is folded
from each state it can begin in, which gives a small table from state to state; such tables are folded for a range, and those
of ranges for a conversation. Texts move once, for the repaired turns, which stream past the conversation's audit.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmine.functions.grounding import bound
from quillmine.llm.common import WORD, give_back_memory
from quillmine.operators.tracking import in_ranges

#: Turns folded at once: what one fold's arrays hold at most.
BLOCK = 256
#: Costs of the edits, and what a cut-off turn that stays adds.
INSERT, CHANGE, DELETE, CUT_OFF = 3, 3, 4, 3
#: States of the role initials so far: nothing, after s, after u, after a.
STATES = ("s0", "s1", "s2", "s3")
PATH = "struct<cost:bigint,audit:string>"
TABLE = f"struct<{','.join(f'{s}:{PATH}' for s in STATES)}>"
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal")


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and copies (1 or 2) of what is left after damage by crc32(`conv_id:turn`) mod 20: 0 drops a row,
    1 empties its text, 2 takes out its sentence ends, 3 doubles it, 4 makes its role user. A null counts as one space, but
    conv_id and turn stay null as keys."""
    given = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    harm = F.crc32(F.concat(given("conv_id"), F.lit(":"), given("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", given("role").alias("role"), given("text").alias("text"), harm.alias("harm")).where("harm <> 0")
    text = F.when(F.col("harm") == 1, "").when(F.col("harm") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("harm") == 4, "user").otherwise(F.col("role"))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.when(F.col("harm") == 3, 2).otherwise(1).alias("copies"))


def _given(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, digest, copies, with one space for null roles and texts."""
    given = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    copies = F.col("copies") if "copies" in turns.columns else F.lit(1)
    rows = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), given("role").alias("role"), given("text").alias("text"), copies.cast("long").alias("copies"))
    return rows.withColumn("digest", F.unhex(F.md5(F.col("text").cast("binary"))))


def flagged(turns: DataFrame) -> DataFrame:
    """Turns in ranges of (conv_id, turn, role, digest), equal rows as one with their number n, and for each: initial, blank,
    cut_off, seen (an earlier turn has its role and text), new_turn and illegal beside the one before in the range."""
    last = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    rows = _given(turns).withColumns({"blank": ~F.col("text").rlike(WORD), "cut_off": ~last.isin(".", "!", "?"), "initial": F.substring("role", 1, 1)})
    rows = rows.groupBy("conv_id", "turn", "role", "digest", "initial", "blank", "cut_off").agg(F.sum("copies").alias("n"))
    ranged = in_ranges(rows, "conv_id", "turn", "role", "digest")
    # a conversation that goes on in a later range is in the last or first place of one, so these are no more than the ranges
    spread = ranged.groupBy("conv_id").agg(F.min("_part").alias("first_part"), F.max("_part").alias("last_part")).where("first_part < last_part")
    spread = F.broadcast(spread.select(F.col("conv_id").alias("spread_id"), "first_part"))
    own = ranged.join(spread, F.col("conv_id").eqNullSafe(F.col("spread_id")), "left").withColumn("starts", F.coalesce(F.col("_part") == F.col("first_part"), F.lit(True)))
    own = own.withColumn("spread", F.col("first_part").isNotNull()).drop("spread_id", "first_part").repartition("conv_id", "_part")
    same = F.row_number().over(Window.partitionBy("conv_id", "_part", "role", "digest").orderBy("_at"))
    before = Window.partitionBy("conv_id", "_part").orderBy("_at")
    pair = F.concat(F.lag("initial").over(before), F.col("initial"))
    own = own.withColumn("seen", same > 1).withColumns({
        "new_turn": F.col("turn").isNotNull() & ~F.lag("turn").over(before).eqNullSafe(F.col("turn")),
        "illegal": F.coalesce((~pair.isin("su", "ua", "au")).cast("long"), F.lit(0)) + F.when(F.concat("initial", "initial").isin("su", "ua", "au"), 0).otherwise(F.col("n") - 1),
    })
    # firsts of ranges of conversations that several ranges hold: a key has at most a row for each range
    firsts = own.where(F.col("spread") & ~F.col("seen") & ~F.col("blank")).select("conv_id", "role", "digest", "_part", "_at")
    later = firsts.withColumn("place", F.row_number().over(Window.partitionBy("conv_id", "role", "digest").orderBy("_part"))).where("place > 1")
    later = later.select(F.col("_part").alias("later_part"), F.col("_at").alias("later_at"))
    own = own.join(later, (F.col("_part") == F.col("later_part")) & (F.col("_at") == F.col("later_at")), "left")
    return own.withColumn("seen", F.col("seen") | F.col("later_part").isNotNull()).drop("later_part", "later_at", "spread")


def _path(c: Column, cost: Column | int, letters: Column | str) -> Column:
    """c with more edits; null (out of reach) stays null."""
    cost = F.lit(cost).cast("long") if isinstance(cost, int) else cost
    letters = F.lit(letters) if isinstance(letters, str) else letters
    return F.when(c.isNotNull(), F.struct((c["cost"] + cost).alias("cost"), F.concat(c["audit"], letters).alias("audit")))


def _with_inserts(values: dict[str, Column]) -> Column:
    """States after any useful number of insertions: at most two in a row, as a third comes back to a state."""
    return bound(values, lambda x: F.struct(
        x["s0"].alias("s0"), x["s1"].alias("s1"),
        F.least(x["s2"], *[_path(x[k], INSERT, "I") for k in ("s0", "s1", "s3")]).alias("s2"),
        F.least(x["s3"], _path(x["s2"], INSERT, "I"), *[_path(x[k], 2 * INSERT, "II") for k in ("s0", "s1")]).alias("s3"),
    ))


def _starts(only_first: Column) -> Column:
    """The struct to begin with in each state, insertions included; a stretch that begins its conversation needs the first only."""

    def path(inserts: int | None) -> Column:
        return F.lit(None).cast(PATH) if inserts is None else F.struct(F.lit(INSERT * inserts).cast("long").alias("cost"), F.lit("I" * inserts).alias("audit"))

    inserts = ((0, None, 1, 2), (None, 0, 1, 2), (None, None, 0, 1), (None, None, 1, 0))
    first, *rest = [F.struct(*[path(k).alias(s) for k, s in zip(own, STATES)]).cast(TABLE) for own in inserts]
    return F.when(only_first, F.array(first)).otherwise(F.array(first, *rest))


def folded(turns: Column, starts: Column) -> Column:
    """For each struct to begin with, the four (cost, audit) structs after an array of (at, initial, gone, late, n)."""

    def step(x: Column, turn: Column) -> Column:
        rest = F.repeat(F.lit("D"), (turn["n"] - 1).cast("int"))
        more, keep = {"D": F.concat(F.lit("D"), rest)}, {}
        for initial in "sua":
            fits = turn["initial"] == initial
            keep[initial] = turn["late"] + DELETE * (turn["n"] - 1) + F.when(fits, 0).otherwise(CHANGE).cast("long"), F.concat(F.when(fits, "K").otherwise("R"), rest)
        kept = lambda state, initial: F.when(~turn["gone"], _path(x[state], *keep[initial]))
        deleted = {s: _path(x[s], DELETE * turn["n"], more["D"]) for s in STATES}
        return _with_inserts({
            "s0": deleted["s0"], "s1": F.least(deleted["s1"], F.when(turn["initial"] == "s", kept("s0", "s"))),
            "s2": F.least(deleted["s2"], *[kept(k, "u") for k in ("s0", "s1", "s3")]),
            "s3": F.least(deleted["s3"], kept("s2", "a")),
        })

    return F.transform(starts, lambda start: F.aggregate(turns, start, step))


def chained(tables: Column, starts: Column) -> Column:
    """The same for stretches in order, each with what folded() gives for it as table."""

    def step(x: Column, stretch: Column) -> Column:
        def way(k: int, j: str) -> Column:
            rest = F.get(stretch["table"], F.lit(k))[j]
            return F.when(rest.isNotNull(), _path(x[STATES[k]], rest["cost"], rest["audit"]))

        return F.struct(*[F.least(*[way(k, j) for k in range(len(STATES))]).alias(j) for j in STATES])

    return F.transform(starts, lambda start: F.aggregate(tables, start, step))


def audits(turns: DataFrame) -> DataFrame:
    """One row for each conversation with turns: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit.

    turns: conv_id, turn, role, text and, if equal rows are given as one, copies. A null role or text is one space; turns come
    by number, nulls first, those of one number by role and then by MD5 of the text. Rows with a null conv_id are one
    conversation. An empty table gives no rows."""
    rows = flagged(turns)
    gone, late = F.col("blank") | F.col("seen"), F.when(F.col("cut_off"), CUT_OFF).otherwise(0).cast("long")
    turn = F.struct(F.col("_at").alias("at"), "initial", gone.alias("gone"), late.alias("late"), "n")
    fresh = F.when(F.col("blank"), 0).when(F.col("seen"), F.col("n")).otherwise(F.col("n") - 1)
    rows = rows.withColumns({"first_at": F.min("_at").over(Window.partitionBy("conv_id", "_part"))})
    sums = {
        "starts": F.min("starts"), "first_turn": F.min("turn"), "last_turn": F.max("turn"), "n_turns": F.sum(F.col("new_turn").cast("long")), "illegal": F.sum("illegal"),
        "blank": F.sum(F.when(F.col("blank"), F.col("n")).otherwise(0)), "duplicate": F.sum(fresh), "truncated": F.sum(F.when(~gone & F.col("cut_off"), 1).otherwise(0)),
        "turns": F.array_sort(F.collect_list(turn)),
    }
    block = F.floor((F.col("_at") - F.col("first_at")) / BLOCK).alias("block")
    blocks = rows.groupBy("conv_id", "_part", block).agg(*[v.alias(k) for k, v in sums.items()])
    blocks = blocks.withColumn("begins", F.col("starts") & (F.col("block") == 0))
    ends = {"first_initial": F.get("turns", F.lit(0))["initial"], "last_initial": F.element_at("turns", -1)["initial"]}
    blocks = blocks.select(*[c for c in blocks.columns if c != "turns"], *[v.alias(k) for k, v in ends.items()], folded(F.col("turns"), _starts(F.col("begins"))).alias("table"))
    tables = F.array_sort(F.collect_list(F.struct("block", "table")))
    parts = blocks.groupBy("conv_id", "_part").agg(
        F.min("starts").alias("starts"), F.min("first_turn").alias("first_turn"), F.max("last_turn").alias("last_turn"), *[F.sum(c).alias(c) for c in ("n_turns", *COUNTS[1:])],
        F.min_by("first_initial", "block").alias("first_initial"), F.max_by("last_initial", "block").alias("last_initial"), tables.alias("tables"),
    )
    parts = parts.select(*[c for c in parts.columns if c != "tables"], chained(F.col("tables"), _starts(F.col("starts"))).alias("table"))
    # what lies across the border of two ranges: one turn number in both, and the pair of initials
    before = Window.partitionBy("conv_id").orderBy("_part")
    pair = F.concat(F.lag("last_initial").over(before), F.col("first_initial"))
    shared = F.max("last_turn").over(before.rowsBetween(Window.unboundedPreceding, -1)) == F.col("first_turn")
    parts = parts.withColumns({"n_turns": F.col("n_turns") - F.coalesce(shared.cast("long"), F.lit(0)), "illegal": F.col("illegal") + F.coalesce((~pair.isin("su", "ua", "au")).cast("long"), F.lit(0))})
    tables = F.array_sort(F.collect_list(F.struct("_part", "table")))
    found = parts.groupBy("conv_id").agg((F.max("last_turn") - F.min("first_turn") + 1 - F.sum("n_turns")).alias("span"), *[F.sum(c).alias(c) for c in COUNTS[1:]], tables.alias("tables"))
    found = found.withColumn("ends", F.get(chained(F.col("tables"), _starts(F.lit(True))), F.lit(0)))
    best = F.least("ends.s0", "ends.s3")
    return found.select("conv_id", F.coalesce("span", F.lit(0)).alias("gaps"), *COUNTS[1:], best["cost"].alias("cost"), best["audit"].alias("audit"))


def _streamed(turns: DataFrame, audit: DataFrame) -> DataFrame:
    """Texts in the order of the fold, each conversation's audit before them; a conversation is in one partition, which reads
    it as a stream."""
    texts = _given(turns).select("conv_id", F.lit(1).alias("kind"), "turn", "role", "digest", "text", "copies")
    heads = audit.select("conv_id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.lit(b"").alias("digest"), F.col("audit").alias("text"), F.lit(0).cast("long").alias("copies"))
    order = ("conv_id", "kind", "turn", "role", "digest")
    return heads.unionByName(texts).repartition("conv_id").sortWithinPartitions(*order).select("conv_id", "kind", "role", "text", "copies")


class Replay:
    """Reads one conversation's turns past its audit."""

    def __init__(self, audit: str):
        self.audit, self.at, self.place, self.speakers = audit, 0, 0, 0

    def _next(self, edit: str, role: str | None, text: str) -> tuple[int, str, str, str]:
        if role is None or edit == "R":
            role = "assistant" if self.speakers % 2 else "user"
        self.speakers += not (edit == "K" and role[:1] == "s")
        self.place += 1
        return self.place - 1, role, text, edit

    def inserted(self) -> Iterator[tuple[int, str, str, str]]:
        while self.audit.startswith("I", self.at):
            self.at += 1
            yield self._next("I", None, "")

    def turn(self, role: str, text: str) -> Iterator[tuple[int, str, str, str]]:
        """What comes out up to and with this turn: (place, role, text, edit)."""
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit != "D":
            yield self._next(edit, role, text)


def _replays(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, Iterator | None]]:
    """(conv_id, turns that come out) as the stream goes on, and (conv_id, None) at a conversation's end."""
    replay, conv_id = None, None
    for batch in batches:
        columns = [batch.column(k).to_pylist() for k in range(batch.num_columns)]
        for own, kind, role, text, copies in zip(*columns):
            if kind == 0:
                if replay:
                    yield conv_id, replay.inserted()
                    yield conv_id, None
                replay, conv_id = Replay(text), own
            else:
                for _ in range(copies):
                    yield conv_id, replay.turn(role, text)
    if replay:
        yield conv_id, replay.inserted()
        yield conv_id, None


def repaired(turns: DataFrame) -> DataFrame:
    """conv_id, place (from 0), role, text, edit (K, R or I) of every turn that is there after the repair. Nulls, ties, repeated
    rows and empty tables as for audits()."""
    schema = turns.select("conv_id").schema.add("place", "long").add("role", "string").add("text", "string").add("edit", "string")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size = [], 0
        for conv_id, found in _replays(batches):
            for x in found or ():
                out.append((conv_id, *x))
                size += len(x[2]) + 64
                if size > 1 << 22:
                    yield _batch(out, kinds)
                    out, size = [], 0
        if out:
            yield _batch(out, kinds)
        give_back_memory()

    kinds = _arrow(turns, schema)
    return _streamed(turns, audits(turns)).mapInArrow(rows, schema)


def _arrow(turns: DataFrame, schema) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _batch(rows: list[tuple], kinds: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), kinds)], schema=kinds)


def digests(turns: DataFrame, audit: DataFrame) -> DataFrame:
    """conv_id, repaired_sha256: of the repaired `role:text`, joined by line ends, summed up as they stream by."""
    schema = turns.select("conv_id").schema.add("repaired_sha256", "string")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, sha = [], hashlib.sha256()
        for conv_id, found in _replays(batches):
            if found is None:
                out.append((conv_id, sha.hexdigest()))
                sha = hashlib.sha256()
                if len(out) >= 10_000:
                    yield _batch(out, kinds)
                    out = []
            for place, role, text, _ in found or ():
                sha.update((("\n" if place else "") + role + ":" + text).encode("utf-8", "surrogatepass"))
        if out:
            yield _batch(out, kinds)
        give_back_memory()

    kinds = _arrow(turns, schema)
    return _streamed(turns, audit).mapInArrow(rows, schema)


def report(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """For every conv_id of conversations (null is one): the columns of audits() and repaired_sha256; zeros, an empty audit and the
    hash of nothing where no turn is left."""
    from quillmine.llm.common import stored

    audit = stored(audits(turns), "audits")
    found = audit.join(digests(turns, audit).withColumnRenamed("conv_id", "_own"), F.col("conv_id").eqNullSafe(F.col("_own"))).drop("_own")
    ids = conversations.select(F.col("conv_id").alias("_id")).distinct()
    rows = ids.join(found, F.col("_id").eqNullSafe(F.col("conv_id")), "left")
    numbers = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in (*COUNTS, "cost")]
    return rows.select(F.col("_id").alias("conv_id"), *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
