"""Whether a quote stands in its source: as one stretch, or as its tokens in order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmine.functions import text as T


def bound(values: dict[str, Column], result) -> Column:
    """result(struct of values), with each value computed once however often result uses it."""
    return F.get(F.transform(F.array(F.struct(*[v.alias(n) for n, v in values.items()])), result), F.lit(0))


def tokens_in_order(quote: Column, source: Column) -> Column:
    """Each token of the quote is found in the source after the one before it; false for a quote without tokens. One
    pass over the source's tokens with a place in the quote's."""
    advance = lambda x: F.aggregate(x["theirs"], F.lit(0), lambda at, token: F.when(F.get(x["own"], at) == token, at + 1).otherwise(at))
    return bound({"own": T.tokens(quote), "theirs": T.tokens(source)}, lambda x: (F.size(x["own"]) > 0) & (advance(x) == F.size(x["own"])))


def longest_prefix(quote: Column, source: Column) -> Column:
    """Length of the longest prefix of the quote that the source contains, by bisection (a shorter prefix of a
    contained one is contained as well). Both are computed once, not at each step."""
    return bound({"quote": quote, "source": source}, lambda x: _bisected(x["quote"], x["source"]))


def _bisected(quote: Column, source: Column) -> Column:
    start = F.struct(F.lit(0).alias("low"), F.length(quote).alias("high"))
    steps = F.sequence(F.lit(1), F.greatest(F.lit(1), F.ceil(F.log2(F.length(quote) + F.lit(2.0))).cast("int") + 1))

    def step(s, _):
        middle = F.floor((s["low"] + s["high"] + 1) / 2).cast("int")
        hit = F.contains(source, F.substring(quote, F.lit(1), middle))
        done = s["low"] >= s["high"]
        return F.struct(F.when(~done & hit, middle).otherwise(s["low"]).alias("low"), F.when(~done & ~hit, middle - 1).otherwise(s["high"]).alias("high"))

    return F.aggregate(steps, start, step, lambda s: s["low"])


def grounding_error(quote: Column, source: Column) -> Column:
    """Null if the quote is grounded, else what is wrong and where it stops to agree."""

    def judge(x):
        q, s = x["q"], x["s"]
        where = F.transform(F.array(longest_prefix(q, s)), lambda n: F.concat(F.lit("not a quote: matched_prefix_chars="), n.cast("string"), F.lit(", near: "), F.substring(q, F.greatest(F.lit(1), n - 39), F.lit(120))))
        sound = F.lit(None).cast("string")
        return F.when(q == "", F.lit("empty quote")).when(F.contains(s, q), sound).when(tokens_in_order(q, s), sound).otherwise(F.get(where, F.lit(0)))

    return bound({"q": T.one_line(F.coalesce(quote, F.lit(""))), "s": T.one_line(F.coalesce(source, F.lit("")))}, judge)


def nested_error(citations: Column, outer: Column, targets: Column, texts: Column) -> Column:
    """What is wrong with the first nested record that is not grounded, else null. citations: as nested.citations gives
    them; targets, texts: the batch's paragraph numbers and their texts.

    Each must name a target. One that names another paragraph than the outer record needs a quote of its own; a quote must
    stand in the paragraph that the record names."""

    def judge(x):
        index, quote = x["paragraph_index"], x["source_quote"]
        text = F.get(texts, F.coalesce(F.array_position(targets, index).cast("int"), F.lit(0)) - 1)
        blank = F.coalesce(T.strip(quote), F.lit("")) == ""
        wrong = (
            F.when(text.isNull(), F.lit("paragraph_index must name a target"))
            .when(blank & (index != outer), F.lit("source_quote is required for another paragraph"))
            .when(~blank, grounding_error(quote, text))
        )
        return F.concat(x["path"], F.lit(": "), wrong)

    return F.get(F.filter(F.transform(citations, judge), lambda e: e.isNotNull()), F.lit(0))


def checked_observations(observations: DataFrame, has_content: Column, citations: Column) -> DataFrame:
    """Observations (paragraph_index, source_quote, targets, texts, ...) with verdict: kept, dropped (no content),
    or the error of the outer or else of the first nested record. targets, texts: numbers and texts of the paragraphs that
    the call was about."""
    source = F.get(F.col("texts"), F.coalesce(F.array_position("targets", F.col("paragraph_index")).cast("int"), F.lit(0)) - 1)
    error = F.coalesce(grounding_error(F.col("source_quote"), source), nested_error(citations, F.col("paragraph_index"), F.col("targets"), F.col("texts")))
    verdict = F.when(~has_content, F.lit("dropped")).when(source.isNull(), F.lit("unknown paragraph")).otherwise(F.coalesce(error, F.lit("kept")))
    return observations.withColumn("verdict", verdict)


def foreign_indexes(indexes: Column, observed: Column) -> Column:
    """Paragraph indexes that were not observed."""
    return F.array_except(indexes, observed)


def within_batch(records: Column, observed: Column) -> Column:
    """Records whose paragraph_index was observed (or is null)."""
    return F.filter(records, lambda r: r["paragraph_index"].isNull() | F.array_contains(observed, r["paragraph_index"]))
