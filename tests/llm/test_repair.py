"""Conversation repair against an exhaustive search and a plain replay."""

import functools
import hashlib
import random
import re
import zlib

import pytest

from quillmine.llm import queries, repair


def plain_rows(rows):
    """Rows after damage, by conversation."""
    out = {}
    for conv_id, turn, role, text in rows:
        key = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
        role, text = " " if role is None else role, " " if text is None else text
        harm = zlib.crc32(key.encode()) % 20
        out.setdefault(conv_id, [])
        if harm == 0:
            continue
        text = "" if harm == 1 else re.sub("[.!?]", "", text) if harm == 2 else text
        out[conv_id] += [(turn, "user" if harm == 4 else role, text)] * (2 if harm == 3 else 1)
    return out


def faults(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).digest()))
    seen, found = set(), []
    for _, role, text in rows:
        signs = re.findall(r"[^\x20\x09-\x0D]", text)
        found.append("blank" if not signs else "duplicate" if (role, text) in seen else "truncated" if signs[-1] not in ".!?" else "")
        seen.add((role, text))
    return rows, found


def plain_repair(rows):
    """The least (cost, audit) over all ways, by recursion over suffixes."""
    rows, found = faults(rows)

    @functools.lru_cache(None)
    def best(k, state, inserts):
        ways = []
        moves = {"0": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}[state]
        if k == len(rows) and state in "0a":
            ways.append((0, ""))
        if inserts < 3:
            for x in "ua":
                if x in moves:
                    c, a = best(k, moves[x], inserts + 1)
                    ways.append((c + 3, "I" + a))
        if k < len(rows):
            c, a = best(k + 1, state, 0)
            ways.append((c + 4, "D" + a))
            if found[k] not in ("blank", "duplicate"):
                late = 3 if found[k] == "truncated" else 0
                if rows[k][1][:1] in moves:
                    c, a = best(k + 1, moves[rows[k][1][:1]], 0)
                    ways.append((c + late, "K" + a))
                for x in "ua":
                    if x in moves:
                        c, a = best(k + 1, moves[x], 0)
                        ways.append((c + 3 + late, "R" + a))
        return min(ways) if ways else (10**9, "")

    for k in range(len(rows), 0, -1):  # so that the recursion stays shallow
        for state in "0sua":
            best(k, state, 0)
    cost, audit = best(0, "0", 0)
    out, k, state = [], 0, "0"
    for edit in audit:
        if edit == "I" or edit == "R":
            role = "assistant" if state == "u" else "user"
            out.append((role, "" if edit == "I" else rows[k][2]))
        elif edit == "K":
            out.append((rows[k][1], rows[k][2]))
        k += edit != "I"
        if edit != "D":
            state = out[-1][0][:1]
    initials = [r[1][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    turns = [r[0] for r in rows if r[0] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
    return (gaps, *[found.count(x) for x in ("blank", "duplicate", "truncated")], illegal, cost, audit, digest)


COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
SCHEMA = "conv_id long, turn long, role string, text string, copies string, digest string"


def made(seed, n, longest):
    luck, rows = random.Random(seed), []
    for conv_id in [None, *range(n)]:
        for turn in range(luck.randrange(longest)):
            role = luck.choice(["user", "assistant", "user", "assistant", "system", None, "", "tool"])
            text = luck.choice([None, "", " \n", "One.", "One", "Two!", f"{turn}. Ünd?", f"{turn}", "x y ", "three.  \t"])
            rows += [(conv_id, luck.choice([turn, turn, turn, None, turn + 5]), role, text)] * luck.choice([1, 1, 1, 2])
    return rows


def got(df):
    return {r.conv_id: tuple(r[c] for c in COLUMNS) for r in df.collect()}


@pytest.mark.parametrize("block", [256, 3])
def test_every_way_is_searched(spark, tmp_path, monkeypatch, block):
    monkeypatch.setattr(repair, "BLOCK", block)
    rows = made(block, 60, 9)
    spark.createDataFrame([(*r, "c", "d") for r in rows], SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    found = got(queries.op12_conversation_repair(spark, str(tmp_path)))
    assert found == {k: plain_repair(v) for k, v in plain_rows(rows).items()}


def test_conversation_over_many_ranges(spark, monkeypatch):
    """One conversation has most rows, texts come again ranges later, and equal rows abound."""
    monkeypatch.setattr(repair, "BLOCK", 16)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        check_spread(spark)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def check_spread(spark):
    luck = random.Random(5)
    rows = [(7, t, luck.choice(["user", "assistant"]), luck.choice(["Yes.", "No.", f"{t}.", f"{t}", ""])) for t in range(400)] + [(7, 50, "user", "Yes.")] * 40
    rows += [(k, t, ("user", "assistant")[t % 2], f"{t} {k}.") for k in (1, 9) for t in range(4)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert repair.flagged(turns).where("conv_id = 7").select("_part").distinct().count() > 1
    plain = {k: plain_repair([r[1:] for r in rows if r[0] == k]) for k in (1, 7, 9)}
    assert got(repair.report(turns, turns)) == plain
    out = sorted((r.place, r.role, r.text, r.edit) for r in repair.repaired(turns).where("conv_id = 7").collect())
    assert hashlib.sha256("\n".join(f"{r}:{t}" for _, r, t, _ in out).encode()).hexdigest() == plain[7][-1]
    assert re.fullmatch("(s?(ua)+)?", "".join(r[:1] for _, r, _, _ in out)) and [p for p, *_ in out] == list(range(len(out)))


def test_empty_table(spark):
    turns = spark.createDataFrame([], SCHEMA)
    assert not repair.report(turns.drop("copies"), turns).collect() and not repair.repaired(turns.drop("copies")).collect()


def test_query_over_the_tables(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(queries.op12_conversation_repair(spark, sf)) == {k: plain_repair(v) for k, v in plain_rows(rows).items()}
