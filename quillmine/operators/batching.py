"""Paragraph batches under a token budget, each led in by the paragraphs before it."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmine.functions import text as T

BATCH_TYPE = "array<struct<batch_id:int,context_from:int,first:int,last:int,tokens:long>>"


def batches_of(sizes, budget: int, overlap: int) -> list[tuple[int, int, int, int, int]]:
    """(batch_id, context_from, first, last, tokens) over paragraphs 1..n of these sizes: context_from..first-1 lead in.

    The lead-in is the shortest run of paragraphs before `first` that has `overlap` tokens; it counts towards the budget,
    and the first paragraph always goes in. With prefix sums each end is found by bisection."""
    if budget <= 0:
        raise ValueError("the budget must be positive")
    upto = np.concatenate([[0], np.cumsum(np.asarray(sizes, np.int64))])
    found, at, n = [], 0, len(upto) - 1
    while at < n:
        lead = max(0, int(np.searchsorted(upto, upto[at] - overlap, side="right")) - 1) if overlap > 0 and at else at
        end = max(at + 1, int(np.searchsorted(upto, upto[lead] + budget, side="right")) - 1)
        found.append((len(found) + 1, lead + 1, at + 1, end, int(upto[end] - upto[lead])))
        at = end
    return found


def batch_column(sizes: Column, budget: int, overlap: int) -> Column:
    """W6, W7 over an array of paragraph sizes in tokens."""

    @F.pandas_udf(BATCH_TYPE)
    def cut(column: pd.Series) -> pd.Series:
        names = ("batch_id", "context_from", "first", "last", "tokens")
        return column.map(lambda sizes: [dict(zip(names, b)) for b in batches_of(sizes, budget, overlap)], na_action="ignore")

    return cut(sizes)


def batch_table(docs: DataFrame, budget: int, overlap: int, count=T.token_count, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Batches of each document's numbered paragraphs, with token totals by `count` (a column function)."""
    rows = docs.select(F.col(id_column).alias("doc_id"), T.paragraphs(T.normalize_plain(F.col(text_column))).alias("parts"))
    sizes = F.transform("parts", lambda x, i: count(T.paragraph_block(i + 1, x)))
    return rows.select("doc_id", F.inline(batch_column(sizes, budget, overlap)))
