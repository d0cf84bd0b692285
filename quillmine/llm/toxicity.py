"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

n-grams of UTF-8 bytes of the lower-cased text, white space as one space, are hashed into a fixed table. From a bounded
sample of labelled documents come each n-gram's document counts per label and so its log-count ratio; those whose ratio
is far from chance are the features. A feature's value is the logarithm of its count in the text times its ratio, and
logistic regression on the same sample weighs them, beside the logarithm of the text's length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmine.llm.common import bounded_sample, give_back_memory, in_fold, row_columns, row_struct, stored

SIZES = (3, 4, 5, 6, 7)
TABLE_BITS = 20
#: Labelled rows of each label that the model is fitted on at most.
SAMPLE_OF_LABEL = 2500
#: A feature's log-count ratio is so many standard errors from chance, and so many of the sample's texts have it.
LEAST_Z, LEAST_DOCS = 2.5, 3
SMOOTHING = 0.5
STEPS, RIDGE = 250, 2e-3
#: Bytes hashed at once.
CHUNK = 1 << 20
FOLD, HELD_OUT = 5, 0


def normal_bytes(text: str | None) -> bytes:
    return b" " + b" ".join((text or "").lower().encode("utf-8", "surrogatepass").split()) + b" "


def gram_slots(data: bytes):
    """Slots of all n-grams, a chunk at a time."""
    longest = max(SIZES)
    for at in range(0, max(1, len(data) - min(SIZES) + 1), CHUNK):
        part = np.frombuffer(data[at : at + CHUNK + longest - 1], np.uint8).astype(np.uint64)
        code, n = part.copy(), 1
        for size in range(2, longest + 1):
            if len(part) < size:
                break
            code, n = code[: len(part) - size + 1] * np.uint64(0x9E3779B97F4A7C15) + part[size - 1 :], size
            if n in SIZES:
                yield ((code ^ np.uint64(n)) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(64 - TABLE_BITS))[:CHUNK].astype(np.int64)


def gram_counts(text: str | None, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, float]:
    """(slots, counts, logarithm of the length); wanted: a flag per slot, others are left out."""
    data, found = normal_bytes(text), []
    for slots in gram_slots(data):
        found.append(slots if wanted is None else slots[wanted[slots]])
    slots, counts = np.unique(np.concatenate(found), return_counts=True) if found else (np.empty(0, np.int64), np.empty(0, np.int64))
    return slots, counts, float(np.log(len(data)))


class Model:
    """slot weights (zero: no feature), bias and the weight of the length."""

    def __init__(self, slots: np.ndarray, weights: np.ndarray, bias: float, length: float):
        self.slots, self.weights, self.bias, self.length = slots.astype(np.int32), weights.astype(np.float32), bias, length
        self._table = None

    def __getstate__(self):
        return self.__dict__ | {"_table": None}

    def score(self, text: str | None) -> float:
        if self._table is None:
            table, wanted = np.zeros(1 << TABLE_BITS, np.float32), np.zeros(1 << TABLE_BITS, bool)
            table[self.slots], wanted[self.slots] = self.weights, True
            self._table = table, wanted
        table, wanted = self._table
        slots, counts, length = gram_counts(text, wanted)
        margin = self.bias + self.length * length + float((table[slots] * np.log1p(counts)).sum())
        return float(1 / (1 + np.exp(-np.clip(margin, -40, 40))))


def slot_counts(rows: DataFrame) -> DataFrame:
    """slot, n0, n1: in how many texts of each label (column label) an n-gram of that slot is. Tasks sum up their own first."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        docs = np.zeros((2, 1 << TABLE_BITS), np.int32)
        for batch in batches:
            for text, label in zip(batch["text"], batch["label"]):
                docs[label, gram_counts(text)[0]] += 1
        slots = np.flatnonzero(docs.any(axis=0))
        if len(slots):
            yield pd.DataFrame({"slot": slots, "n0": docs[0, slots], "n1": docs[1, slots]})
        give_back_memory()

    return rows.select("text", "label").mapInPandas(count, "slot long, n0 long, n1 long").groupBy("slot").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


def chosen_slots(slots: np.ndarray, docs: np.ndarray, n_of: list[int], most: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(slots that are features, in order; their log-count ratios): all that are sure enough, or the `most` surest of them.
    docs: texts of each label that have the slot."""
    # ratio of the shares of documents of each label that hold the n-gram, and how sure it is
    ratio = np.log((docs[1] + SMOOTHING) / (n_of[1] + 2 * SMOOTHING)) - np.log((docs[0] + SMOOTHING) / (n_of[0] + 2 * SMOOTHING))
    z = np.abs(ratio) / np.sqrt(1 / (docs[1] + SMOOTHING) + 1 / (docs[0] + SMOOTHING))
    z[docs.sum(axis=0) < LEAST_DOCS] = 0
    best = np.lexsort((slots, -z))[:most]
    best = best[z[best] >= LEAST_Z]
    best = best[np.argsort(slots[best])]
    return slots[best], ratio[best]


def sparse_rows(rows: DataFrame, chosen: np.ndarray, ratio: np.ndarray) -> DataFrame:
    """doc_id, label, length, places, values: what a text has of the chosen slots, as bytes."""
    shared = rows.sparkSession.sparkContext.broadcast((chosen, ratio))

    def convert(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        chosen, ratio = shared.value
        place = np.full(1 << TABLE_BITS, -1, np.int32)
        place[chosen] = np.arange(len(chosen))
        wanted = place >= 0
        for batch in batches:
            out = []
            for text in batch["text"]:
                slots, counts, length = gram_counts(text, wanted)
                at = place[slots]
                out.append((length, at.tobytes(), (np.log1p(counts) * ratio[at]).astype(np.float32).tobytes()))
            yield pd.DataFrame({"key": batch["key"], "label": batch["label"], **{name: [x[k] for x in out] for k, name in enumerate(("length", "places", "values"))}})
        give_back_memory()

    rows = rows.select(F.col("doc_id").cast("string").alias("key"), "text", "label")
    return rows.mapInPandas(convert, "key string, label int, length double, places binary, values binary").orderBy("key")


def fit(rows: DataFrame) -> Model:
    """rows: doc_id, text, label (0 or 1), a bounded number. With one label only, a constant. Texts stay on executors: what comes
    to the driver is a row for each slot of the table, and each text's share of the chosen ones."""
    found = dict(rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect())
    n_of = [found.get(k, 0) for k in (0, 1)]
    if not all(n_of):
        return Model(np.empty(0), np.empty(0), 3.0 if n_of[1] else -3.0, 0.0)
    counted = slot_counts(rows).where(F.col("n0") + F.col("n1") >= LEAST_DOCS).toArrow()
    docs = np.stack([counted.column(n).to_numpy().astype(np.float64) for n in ("n0", "n1")])
    chosen, ratio = chosen_slots(counted.column("slot").to_numpy(), docs, n_of)
    got = sparse_rows(rows, chosen, ratio).toArrow()
    lengths, label = got.column("length").to_numpy().copy(), got.column("label").to_numpy().astype(np.float64)
    columns, values = (np.concatenate([np.frombuffer(x.as_py(), kind) for x in got.column(name)]) for name, kind in (("places", np.int32), ("values", np.float32)))
    sizes = np.array([len(x.as_py()) // 4 for x in got.column("places")])
    del got
    row_of = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    # a part of the sample's n-grams at a time, as each step makes some numbers of eight bytes for every one of them
    parts = [slice(at, at + CHUNK) for at in range(0, len(columns), CHUNK)]
    centre, n = lengths.mean(), len(lengths)
    # every label has the same total weight while fitting; the sample keeps few rows of the common one
    weight = np.where(label == 1, 0.5 / n_of[1], 0.5 / n_of[0])
    w, rest = np.zeros(len(chosen)), np.zeros(2)
    first, second = np.zeros(len(chosen) + 2), np.zeros(len(chosen) + 2)
    margins = lambda: sum((np.bincount(row_of[k], values[k] * w[columns[k]], n) for k in parts), rest[0] + rest[1] * (lengths - centre))
    for step in range(1, STEPS + 1):
        margin = margins()
        error = weight * (1 / (1 + np.exp(-np.clip(margin, -40, 40))) - label)
        slope = np.concatenate([sum((np.bincount(columns[k], values[k] * error[row_of[k]], len(chosen)) for k in parts), RIDGE * w), [error.sum(), (error * (lengths - centre)).sum()]])
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
        move = 0.03 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
        w, rest = w - move[:-2], rest - move[-2:]
    margin = margins()
    cut = best_cut(margin, label)
    return Model(chosen, w * ratio, float(rest[0] - rest[1] * centre - cut), float(rest[1]))


def best_cut(margin: np.ndarray, label: np.ndarray) -> float:
    """The middle of the gap that gives the fewest errors on the sample; a score of one half is at this margin."""
    order = np.argsort(margin, kind="stable")
    m, y = margin[order], label[order]
    errors = np.concatenate([[0], np.cumsum(y)]) + np.concatenate([[(1 - y).sum()], (1 - y).sum() - np.cumsum(1 - y)])
    best = np.flatnonzero(errors == errors.min())
    k = int(best[np.argmin(np.abs(best - len(m) + y.sum()))])
    return float((m[max(0, k - 1)] + m[min(len(m) - 1, k)]) / 2)


def training_rows(docs: DataFrame, labels: DataFrame, sample_of_label: int = SAMPLE_OF_LABEL) -> DataFrame:
    """(text, label) of a sample of the labelled rows outside the held-out fold: at most sample_of_label of each label, by
    a hash of doc_id. Labels are read without texts first, so the joined side holds at most twice the bound."""
    known = labels.where(F.col("toxic").isin(0, 1) & ~in_fold(F.col("doc_id"), FOLD, HELD_OUT)).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("label"))
    samples = [bounded_sample(known.where(F.col("label") == k), sample_of_label, "toxicity", F.col("doc_id")) for k in (0, 1)]
    sample = F.broadcast(samples[0].unionByName(samples[1]))
    # one row per id, so repeated documents don't exceed the bound
    return docs.select("doc_id", "text").join(sample, "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text")).select("text", "label", "doc_id")


def train(docs: DataFrame, labels: DataFrame, sample_of_label: int = SAMPLE_OF_LABEL) -> Model:
    return fit(stored(training_rows(docs, labels, sample_of_label), "labelled-sample"))


def score_column(text: Column, model: Model, spark) -> Column:
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        found = [shared.value.score(x) for x in texts]
        give_back_memory()
        return pd.Series(found, dtype="float64")

    return score(text)


def scored(docs: DataFrame, labels: DataFrame, sample_of_label: int = SAMPLE_OF_LABEL) -> DataFrame:
    """doc_id, held_out, score, predicted of each document.

    Null and empty texts are scored as texts without n-grams. A null doc_id has no label and counts as held out; repeated
    rows score alike; labels that are null or other than 0 and 1 are left out, and of two labels of one document 1 holds;
    without labels of both kinds the score is a constant on the side of the kind there is; an empty table gives no rows.
    """
    model = train(docs, labels, sample_of_label)
    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), score_column(F.col("text").cast("string"), model, docs.sparkSession).alias("score"))
    return out.select("doc_id", in_fold(F.col("doc_id"), FOLD, HELD_OUT).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, sample_of_label: int = SAMPLE_OF_LABEL) -> DataFrame:
    """docs without those that the classifier rejects, columns as they are. Null and empty texts are scored as texts without
    n-grams; repeated rows go or stay together; without labels of both kinds all have one score; an empty table gives no rows."""
    model = train(docs, labels, sample_of_label)
    columns = docs.columns
    rows = docs.select(row_struct(columns), score_column(F.col("text").cast("string"), model, docs.sparkSession).alias("score"))
    return rows.where("score < 0.5").select(*row_columns(columns))
