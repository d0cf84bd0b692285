"""Concatenate and cut: documents' token ids laid end to end and cut into windows of fixed length.

Pass 1 tokenizes every text once and stores ids with each document's offset inside its partition. Pass 2 adds up the
partitions' totals (one row per partition), which gives global offsets, and cuts windows; a document across a border
gets one piece in each window it touches. No ids are shuffled in either pass.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillmine.llm.common import give_back_memory, stored

SEQUENCE_LENGTH = 1024
END_ID = 0
#: Rows whose ids a task holds at once.
ROWS_AT_ONCE = 250
VOCABULARY = "byte_bpe_50k"
#: A run of white space from this length on goes to the JSON file's own tokenizer: the faster library goes back over such
#: a run once for each character, so its time grows with the square of the run.
LONG_RUN = 512
_LONG_RUN = re.compile(r"\s{%d}" % LONG_RUN)


def has_long_run(text: str) -> bool:
    """Whether the text has LONG_RUN signs of white space in a row. Such a run has two on either side of a multiple of half its
    length, so most texts are settled by a look at these places."""
    half = LONG_RUN // 2
    return any(text[k].isspace() and text[k - 1].isspace() for k in range(half, len(text), half)) and _LONG_RUN.search(text) is not None


#: doc_id crosses Python as text: beside nulls pandas would hold it as a float.
TOKEN_SCHEMA = "part int, part_start long, doc_id string, n_ids long, ids binary"


@lru_cache(maxsize=2)
def encoder(vocabulary: str):
    """text -> ids of the public vocabulary. The ranks file holds the same vocabulary as the JSON file and is read by the
    faster library; a text that holds the special token's string or a very long run of white space goes to the JSON file's
    own tokenizer."""
    import base64

    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    fast = tiktoken.Encoding(vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    full: list[Tokenizer] = []  # read on the first text that needs it

    def encode(text: str) -> list[int]:
        if "<|endoftext|>" in text or has_long_run(text):
            if not full:
                full.append(Tokenizer.from_file(public_tokenizers.path(f"{vocabulary}.json")))
            return full[0].encode(text, add_special_tokens=False).ids
        return fast.encode_ordinary(text)

    return encode


def tokenized(docs: DataFrame, vocabulary: str = VOCABULARY, end_id: int = END_ID) -> DataFrame:
    """One row per document: its ids and the end id as little-endian unsigned 32-bit numbers, and the count of ids before
    it in its partition."""

    def encode_part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, part, start = encoder(vocabulary), TaskContext.get().partitionId(), 0
        for batch in (rows.iloc[at : at + ROWS_AT_ONCE] for rows in batches for at in range(0, len(rows), ROWS_AT_ONCE)):
            ids = [np.array([*encode(text or ""), end_id], dtype="<u4") for text in batch["text"]]
            sizes = np.array([len(x) for x in ids], dtype=np.int64)
            starts = start + np.cumsum(sizes) - sizes
            start += int(sizes.sum())
            yield pd.DataFrame({"part": part, "part_start": starts, "doc_id": batch["doc_id"].to_numpy(), "n_ids": sizes, "ids": [x.tobytes() for x in ids]})
        give_back_memory()

    rows = docs.select(F.col("doc_id").cast("long").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInPandas(encode_part, TOKEN_SCHEMA).withColumn("doc_id", F.col("doc_id").cast("long"))


def pack(docs: DataFrame, length: int = SEQUENCE_LENGTH, vocabulary: str = VOCABULARY, end_id: int = END_ID) -> DataFrame:
    """Pieces of documents in sequences of `length` ids.

    One row per piece: doc_id, start (ids of its document before it), length, ids (bytes), ids_crc32, doc_tokens (with
    the end id), sequence_id, offset (place in the sequence), sequence_tokens, padded_length. Every id is in one piece.
    Only the last sequence can be short; it is padded to `length` unless it already holds a power of two of ids.

    Null text counts as empty (one end id); a null doc_id is kept; repeated rows are packed each on its own; an empty
    table gives no rows; other columns are ignored. The order is that of the input's partitions and their rows.
    """
    tokens = stored(tokenized(docs, vocabulary, end_id), "token-ids")
    totals = tokens.groupBy("part").agg(F.sum("n_ids").alias("part_total"))
    # one row per partition of the input: small at any size, so the running sum fits one task and the result is broadcast
    in_order, everything = Window.orderBy("part"), Window.partitionBy()
    bases = totals.select(
        "part",
        (F.sum("part_total").over(in_order) - F.col("part_total")).alias("part_base"),
        F.sum("part_total").over(everything).alias("all_tokens"),
    )
    placed = tokens.join(F.broadcast(bases), "part").withColumn("at", F.col("part_base") + F.col("part_start"))

    def piece(sequence):
        begin = F.greatest(F.col("at"), sequence * length)
        end = F.least(F.col("at") + F.col("n_ids"), (sequence + 1) * length)
        part = F.substring(F.col("ids"), ((begin - F.col("at")) * 4 + 1).cast("int"), ((end - begin) * 4).cast("int"))
        filled = F.least(F.lit(length).cast("long"), F.col("all_tokens") - sequence * length)
        return F.struct(
            (begin - F.col("at")).alias("start"),
            (end - begin).alias("length"),
            part.alias("ids"),
            F.crc32(part).alias("ids_crc32"),
            F.col("n_ids").alias("doc_tokens"),
            sequence.alias("sequence_id"),
            (begin - sequence * length).alias("offset"),
            filled.alias("sequence_tokens"),
            F.when(filled.bitwiseAND(filled - 1) == 0, filled).otherwise(F.lit(length).cast("long")).alias("padded_length"),
        )

    first, last = F.floor(F.col("at") / length), F.floor((F.col("at") + F.col("n_ids") - 1) / length)
    return placed.select("doc_id", F.explode(F.transform(F.sequence(first, last), piece)).alias("piece")).select("doc_id", "piece.*")
