"""Paragraphs of documents: numbering, offsets, chunks, token windows."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as S

from quillmine.functions import text as T

SEPARATOR = 2


def paragraph_table(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """document_id, paragraph_index and paragraph_order from 1, numbered_text, text of each non-blank line."""
    rows = docs.select(F.col(id_column).cast("string").alias("document_id"), F.posexplode(T.paragraphs(T.normalize_plain(F.col(text_column)))).alias("at", "text"))
    number = (F.col("at") + 1).cast("int")
    return rows.select("document_id", number.alias("paragraph_index"), number.alias("paragraph_order"), T.paragraph_block(number, F.col("text")).alias("numbered_text"), "text")


def numbered_document(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: paragraph_count, numbered_text (one paragraph a line), text (blank line between)."""
    parts = T.paragraphs(T.normalize_plain(F.col(text_column)))
    rows = docs.select(F.col(id_column).cast("string").alias("document_id"), parts.alias("parts"))
    numbered = F.transform("parts", lambda x, i: T.paragraph_block(i + 1, x))
    return rows.select("document_id", F.size("parts").alias("paragraph_count"), F.array_join(numbered, "\n").alias("numbered_text"), F.array_join("parts", "\n\n").alias("text"))


def offsets_of(sizes) -> np.ndarray:
    """Where each paragraph starts, two characters between neighbours."""
    sizes = np.asarray(sizes, np.int64) + SEPARATOR
    return np.cumsum(sizes) - sizes


@F.pandas_udf(S.ArrayType(S.LongType()))
def _offsets(column: pd.Series) -> pd.Series:
    return column.map(offsets_of, na_action="ignore")


def with_offsets(parts: Column) -> Column:
    """P (from 1), start, end, section_tag, text of each paragraph as they lie in the text joined by blank lines. The starts
    are one running sum over the lengths, so the work grows with a document's paragraphs and not with their square."""
    return F.transform(
        F.arrays_zip(parts.alias("text"), _offsets(F.transform(parts, F.length)).alias("start")),
        lambda x, i: F.struct((i + 1).alias("p"), x["start"].alias("start"), (x["start"] + F.length(x["text"])).alias("end"), T.section_tag(x["text"]).alias("section_tag"), x["text"].alias("text")),
    )


def offset_table(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """W4 by a running sum over the paragraphs of a document, which suits documents of very many paragraphs as well."""
    rows = docs.select(F.col(id_column).alias("doc_id"), F.posexplode(T.blank_line_paragraphs(T.normalize_light(F.col(text_column)))).alias("at", "text"))
    upto = Window.partitionBy("doc_id").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.length("text") + SEPARATOR).over(upto) - SEPARATOR
    return rows.select("doc_id", (F.col("at") + 1).alias("p"), (end - F.length("text")).alias("start"), end.alias("end"), T.section_tag(F.col("text")).alias("section_tag"), "text")


def chunks_of(sizes, max_chars: int) -> list[tuple[int, int, int]]:
    """(chunk_id, p_from, p_to) over paragraphs of these sizes; each end is found by bisection in the running sums."""
    upto = np.concatenate([[0], np.cumsum(np.asarray(sizes, np.int64) + SEPARATOR)])
    found, at, n = [], 0, len(upto) - 1
    while at < n:
        room = max_chars + (0 if at else SEPARATOR)
        end = max(at + 1, int(np.searchsorted(upto, upto[at] + room, side="right")) - 1)
        found.append((len(found) + 1, at + 1, end))
        at = end
    return found


def char_chunks(parts: Column, max_chars: int) -> Column:
    """Chunks of paragraphs up to max_chars: chunk_id, p_from, p_to. A single longer paragraph is a chunk. The two
    characters between paragraphs count towards a paragraph even where it then opens a chunk."""

    @F.pandas_udf("array<struct<chunk_id:int,p_from:int,p_to:int>>")
    def cut(column: pd.Series) -> pd.Series:
        names = ("chunk_id", "p_from", "p_to")
        return column.map(lambda sizes: [dict(zip(names, c)) for c in chunks_of(sizes, max_chars)], na_action="ignore")

    return cut(F.transform(parts, F.length))


def chunk_table(docs: DataFrame, max_chars: int, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, custom_id, chunk_id, p_from, p_to, text, labelled text of each chunk."""
    rows = docs.select(F.col(id_column).alias("doc_id"), T.blank_line_paragraphs(T.normalize_light(F.col(text_column))).alias("parts"))
    rows = rows.withColumn("chunk", F.explode(char_chunks(F.col("parts"), max_chars)))
    first, last = F.col("chunk.p_from"), F.col("chunk.p_to")
    return rows.select(
        "doc_id", F.format_string("%s_c%03d", F.col("doc_id").cast("string"), F.col("chunk.chunk_id")).alias("custom_id"), F.col("chunk.chunk_id").alias("chunk_id"), first.alias("p_from"), last.alias("p_to"),
        F.array_join(F.slice("parts", first, last - first + 1), "\n\n").alias("text"), T.labelled_range(F.col("parts"), first, last).alias("labelled_text"),
    )


def token_windows(ids: Column, max_length: int, least: int, first_id: int = 101, last_id: int = 102) -> Column:
    """Slices of max_length - 2 ids between a first and a last id; slices shorter than `least` are left out."""
    room = max_length - 2
    slices = F.transform(F.sequence(F.lit(0), F.greatest(F.size(ids) - 1, F.lit(0)), F.lit(room)), lambda at: F.slice(ids, at + 1, room))
    kept = F.filter(slices, lambda x: F.size(x) >= max(1, least))
    return F.transform(kept, lambda x: F.struct(F.concat(F.array(F.lit(first_id)), x, F.array(F.lit(last_id))).alias("input_ids"), F.array_repeat(F.lit(1), F.size(x) + 2).alias("attention_mask")))
