"""Vocabularies: tokens in corpus order or by frequency, and an ordered union with a base vocabulary."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def merged(base: DataFrame, candidates: DataFrame, most_new: int) -> DataFrame:
    """Base (token, id: 0..n-1 without gaps) and up to most_new unseen candidates (token, place) after it, in the
    order of their first place. most_new = 0 still adds one, as a loop that checks after adding does."""
    size, least, most, different = base.agg(F.count(F.lit(1)), F.min("id"), F.max("id"), F.countDistinct("id")).first()
    if size and (least, most, different) != (0, size - 1, size):
        raise ValueError("the base vocabulary's ids must run from 0 without gaps")
    first = candidates.groupBy("token").agg(F.min("place").alias("place")).join(base.select("token"), "token", "left_anti")
    # a top-k first, so that the window over it sees at most most_new rows
    new = first.orderBy("place", "token").limit(max(1, most_new))
    numbered = new.select("token", (F.row_number().over(Window.orderBy("place", "token")) + size - 1).cast("long").alias("id"))
    return base.select("token", F.col("id").cast("long").alias("id")).unionByName(numbered)


def word_candidates(docs: DataFrame, text_column: str = "text", least: int = 2) -> DataFrame:
    """Words of a corpus with place by falling frequency, then by the word: candidates for `merged`. The number is exact;
    places only order, so no task ranks all words."""
    from quillmine.functions.text import WORD

    words = docs.select(F.explode(F.regexp_extract_all(F.lower(F.col(text_column)), F.lit(f"[{WORD}]+"), F.lit(0))).alias("token"))
    return words.groupBy("token").agg((-F.count(F.lit(1))).alias("place")).where(F.col("place") <= -least)


def in_order(vocabulary: DataFrame) -> DataFrame:
    """By id."""
    return vocabulary.orderBy("id")


def coverage(base: DataFrame, extended: DataFrame) -> DataFrame:
    """Sizes of a vocabulary before and after, and what was added, in one row."""
    n = extended.join(base.select("token", F.lit(True).alias("_old")), "token", "left").agg(F.count_if(F.col("_old").isNotNull()).alias("base"), F.count(F.lit(1)).alias("final"))
    return n.select("base", "final", (F.col("final") - F.col("base")).alias("added"))


def number_words(words: DataFrame) -> DataFrame:
    """token, id: distinct words by their order, from 0 without gaps."""
    from quillmine.operators.tracking import positions

    return positions(words.select("token").distinct(), "token", name="id")


def masked(windows: DataFrame, ids: str, seed: int, mask_id: int, vocabulary_size: int, share: float = 0.15) -> DataFrame:
    """H15's input: windows with masked (ids that a model sees) and labels (-100 where nothing is asked). Of the `share` of
    places drawn by a hash of seed, window and place, eight in ten hold mask_id, one a random id, one the id itself."""
    one = 1 << 30
    luck = lambda name, x, i: F.pmod(F.xxhash64(F.lit(seed), F.lit(name), F.col(ids), i, x), F.lit(one))
    drawn = lambda x, i: luck("drawn", x, i) < int(share * one)
    kind = lambda x, i: F.pmod(luck("kind", x, i), F.lit(10))
    seen = lambda x, i: F.when(~drawn(x, i) | (kind(x, i) == 9), x).when(kind(x, i) == 8, F.pmod(luck("other", x, i), F.lit(vocabulary_size)).cast("int")).otherwise(F.lit(mask_id))
    return windows.withColumn("masked", F.transform(ids, seen)).withColumn("labels", F.transform(ids, lambda x, i: F.when(drawn(x, i), x).otherwise(F.lit(-100))))
