"""Stable hashes of ids, and what is drawn by them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def stable_hash(value: Column, seed) -> Column:
    """The first 8 bytes of SHA-256 of `seed:value` as an unsigned number (a decimal)."""
    seed = seed if isinstance(seed, Column) else F.lit(str(seed))
    return F.conv(F.substring(F.sha2(F.concat(seed.cast("string"), F.lit(":"), value.cast("string")).cast("binary"), 256), 1, 16), 16, 10).cast("decimal(20,0)")


def split_of(doc_id: Column, validation_fraction: float, seed: int) -> Column:
    """Validation if the hash modulo 10000 is below the fraction's ten-thousandths, cut off."""
    return F.when(stable_hash(doc_id, seed) % 10_000 < int(validation_fraction * 10_000), "validation").otherwise("train")


def quota_per_kind(count: int, other_fraction: float, kinds: int) -> int:
    """Documents of each further kind that make the others' share of the whole other_fraction."""
    import math

    if not 0 <= other_fraction < 1:
        raise ValueError("other_fraction must be at least 0 and below 1")
    return math.ceil(count * other_fraction / (1 - other_fraction) / kinds) if count and other_fraction else 0


#: Rounds of a permutation: enough that no place tells of the one before.
ROUNDS = 24


def round_keys(seed: int, rounds: int = ROUNDS) -> list[int]:
    import hashlib

    return [int(hashlib.sha256(f"{seed}:{k}".encode()).hexdigest()[:15], 16) for k in range(rounds)]


def permuted(index: Column, size: int, seed: int, rounds: int = ROUNDS) -> Column:
    """A seeded permutation of the whole numbers below size. In each round a number has a partner, its mirror image about a
    key, and a hash of the pair says whether they trade places."""
    if size < 2:
        return index.cast("long")
    keys = F.array(*[F.lit(k % size).cast("long") for k in round_keys(seed, rounds)])
    pairs = F.transform(keys, lambda key, k: F.struct(key.alias("key"), k.alias("k")))

    def trade(x: Column, r: Column) -> Column:
        other = F.pmod(r["key"] - x, F.lit(size).cast("long"))
        name = F.concat_ws(":", F.lit(str(seed)), r["k"].cast("string"), F.greatest(x, other).cast("string"))
        return F.when(F.substring(F.sha2(name.cast("binary"), 256), 1, 1) >= "8", other).otherwise(x)

    return F.aggregate(pairs, index.cast("long"), trade)


def permuted_sql(index: str, size: str, seed: int, rounds: int = ROUNDS) -> str:
    """permuted() in DuckDB's SQL."""
    found = f"({index})::HUGEINT"
    steps = ", ".join(f"({key}::HUGEINT)" for key in round_keys(seed, rounds))
    other = f"((([{steps}])[r::BIGINT + 1] % ({size}) - x) % ({size}) + ({size})) % ({size})"
    trade = f"CASE WHEN substr(sha256('{seed}:' || r::BIGINT || ':' || greatest(x, {other})), 1, 1) >= '8' THEN {other} ELSE x END"
    return f"list_reduce(list_prepend({found}, list_transform(range({rounds}), lambda k: k::HUGEINT)), lambda x, r: {trade})"
