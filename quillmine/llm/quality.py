"""Quality rules: a decision list learned from labelled statistics, read as one conditional expression.

Tasks count each text once; what the rules compare are shares of these counts, as Spark expressions. Sequential covering
learns the list from a bounded sample: a conjunction of thresholds grows on two thirds of the rows by the information it
gains, is cut back on the last third by its worth there, is taken if it is sure enough there, and what it covers is set
aside for the next. Rules reject in order; a text that none covers is kept.
"""

from __future__ import annotations

import itertools
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmine.llm.common import bounded_sample, give_back_memory, in_fold, row_columns, row_struct

SYMBOLS = "#*$%&|<>"
#: Words of a window, and the base's bounds: least words, and most repeated words of a hundred.
WINDOW, LEAST_WORDS, MOST_REPEATED = 8, 20, 30
#: Labelled rows of each label that the list is learned from at most.
SAMPLE_OF_LABEL = 4000
FOLD, HELD_OUT = 5, 0
#: A rule's bounds: conditions, thresholds tried of each feature, least share of right rejections and least rows on unseen rows.
CONDITIONS, THRESHOLDS, LEAST_PRECISION, LEAST_ROWS, RULES = 4, 48, 0.97, 4, 24
#: Bytes cut into words at once.
CHUNK = 1 << 20
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letters", "n_upper", "n_digits", "n_marks", "n_distinct", "n_bare")
_SPACE = regex.compile(rb"[\x20\x09-\x0D]")


@cache
def _kinds() -> np.ndarray:
    """What each code point counts as: 1 word sign, 2 symbol, 4 letter, 8 capital, 16 digit, 32 mark of ! or ?."""
    found = np.ones(0x110000, np.uint8)
    found[[0x20, *range(9, 14)]] = 0
    for c in range(0x30000):  # there are no letters beyond
        x = chr(c)
        if x.isalpha():
            found[c] |= 12 if x.isupper() else 4
    found[[ord(x) for x in SYMBOLS]] |= 2
    found[range(0x30, 0x3A)] |= 16
    found[[ord("!"), ord("?")]] |= 32
    return found


def word_ids(data: bytes) -> tuple[np.ndarray, list[bytes]]:
    """(number of each word by first appearance, the different words); a stretch of the text at a time."""
    place: dict[bytes, int] = defaultdict(itertools.count().__next__)
    found, at = [np.empty(0, np.int64)], 0
    while at < len(data):
        space = _SPACE.search(data, at + CHUNK) if len(data) > at + CHUNK else None
        end = space.start() if space else len(data)
        words = data[at:end].split()
        found.append(np.fromiter(map(place.__getitem__, words), np.int64, len(words)))
        at = end
    return np.concatenate(found), list(place)


def repeated_words(ids: np.ndarray) -> int:
    """How many words stand in a window that is there twice or more. Equal sums are a first sieve; windows are then told apart
    exactly, by numbers for two, four and eight words."""
    n = len(ids) - WINDOW + 1
    if n < 2:
        return 0
    sums = np.zeros(n, np.uint64)
    for k in range(WINDOW):
        sums = sums * np.uint64(0x9E3779B97F4A7C15) + ids[k : n + k].astype(np.uint64) + np.uint64(1)
    if len(np.unique(sums)) == n:
        return 0
    code, step = ids, 1
    while step < WINDOW:
        code = np.unique(code[:-step] * (code.max() + 1) + code[step:], return_inverse=True)[1].reshape(-1)
        step *= 2
    often = np.bincount(code)[code] > 1
    edges = np.zeros(len(ids) + 1, np.int64)
    edges[:n] += often
    edges[WINDOW:] -= often
    return int((np.cumsum(edges) > 0).sum())


def text_counts(text: str | None) -> tuple[int, ...]:
    """COUNTS of one text; null counts as empty."""
    text = text or ""
    data = text.encode("utf-8", "surrogatepass")
    ids, words = word_ids(data)
    signs = np.zeros(256, np.int64)
    for at in range(0, len(text), CHUNK):
        kinds = _kinds()[np.frombuffer(text[at : at + CHUNK].encode("utf-32-le", "surrogatepass"), np.uint32)]
        signs += np.bincount(kinds, minlength=256)
    having = lambda bit: int(signs[[k for k in range(256) if k & bit]].sum())
    seen: set[bytes] = set()
    n_lines = 0
    for line in data.split(b"\n"):
        if line.split(None, 1):
            n_lines += 1
            seen.add(line)
    bare = np.array([not any(c.isalnum() for c in w.decode("utf-8", "surrogatepass")) for w in words], bool)
    return (
        len(ids), having(1), having(2), n_lines - len(seen), repeated_words(ids), n_lines, having(4), having(8), having(16), having(32), len(words), int(bare[ids].sum()) if len(ids) else 0,
    )


def counted(text: Column) -> Column:
    """A struct of COUNTS."""

    @F.pandas_udf(",".join(f"{c} long" for c in COUNTS))
    def count(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            yield pd.DataFrame([text_counts(x) for x in batch], columns=list(COUNTS))
        give_back_memory()

    return count(text.cast("string"))


def features(counts: Column) -> dict[str, Column]:
    """What rules compare: shares of the counts."""
    share = lambda a, b: F.try_divide(counts[a].cast("double"), F.greatest(counts[b], F.lit(1)).cast("double"))
    return {
        "words": counts["n_words"].cast("double"), "word_length": share("word_chars", "n_words"), "symbols": share("n_symbols", "word_chars"),
        "dup_lines": share("n_dup_lines", "n_lines"), "repeated": share("n_repeat_words", "n_words"), "line_words": share("n_words", "n_lines"),
        "letters": share("n_letters", "word_chars"), "capitals": share("n_upper", "n_letters"), "digits": share("n_digits", "word_chars"),
        "marks": share("n_marks", "n_words"), "distinct": share("n_distinct", "n_words"), "bare_words": share("n_bare", "n_words"),
    }


def base_failed(counts: Column) -> Column:
    return (counts["n_words"] < LEAST_WORDS) | (100 * counts["n_repeat_words"] > MOST_REPEATED * counts["n_words"])


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:g}"

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return (x[self.feature] > self.threshold) == self.above

    def column(self, x: dict[str, Column]) -> Column:
        return x[self.feature] > self.threshold if self.above else x[self.feature] <= self.threshold


@dataclass
class DecisionList:
    """Rules that reject, in order; what no rule covers is kept."""

    rules: list[list[Condition]] = field(default_factory=list)

    def __str__(self) -> str:
        return "\n".join([f"{k}: reject if {' and '.join(map(str, rule))}" for k, rule in enumerate(self.rules, 1)] + ["else keep"])

    def first(self, x: dict[str, np.ndarray], n: int) -> np.ndarray:
        """Number of the first rule that covers a row, from 1; 0: none."""
        found = np.zeros(n, np.int64)
        for k, rule in reversed(list(enumerate(self.rules, 1))):
            found[_covered(rule, x, n)] = k
        return found

    def column(self, x: dict[str, Column]) -> Column:
        """The same as a conditional expression; null where no rule covers."""
        found = F.lit(None).cast("int")
        for k, rule in reversed(list(enumerate(self.rules, 1))):
            every = rule[0].column(x)
            for c in rule[1:]:
                every = every & c.column(x)
            found = F.when(every, k).otherwise(found)
        return found


def _covered(rule: list[Condition], x: dict[str, np.ndarray], n: int) -> np.ndarray:
    found = np.ones(n, bool)
    for c in rule:
        found &= c.holds(x)
    return found


def grown(x: dict[str, np.ndarray], bad: np.ndarray, weight: np.ndarray) -> list[Condition]:
    """Adds the condition with most information about bad rows until no good one is covered or nothing is gained."""
    rule, inside = [], np.ones(len(bad), bool)
    while len(rule) < CONDITIONS:
        p0, n0 = weight[inside & bad].sum(), weight[inside & ~bad].sum()
        if n0 == 0:
            break
        best, gain = None, 1e-9
        for name, values in x.items():
            own = values[inside]
            cuts = np.unique(np.quantile(own[bad[inside]], np.linspace(0, 1, THRESHOLDS + 1)))
            # between two values, so that what is compared is not a value itself
            after = np.searchsorted(np.sort(own), cuts, "right")
            ordered = np.append(np.sort(own), own.max() + 1)
            cuts = np.unique(np.concatenate([(cuts + ordered[after]) / 2, cuts - 1e-9 * np.maximum(1, np.abs(cuts))]))
            order = np.argsort(own, kind="stable")
            p = np.append(0, np.cumsum((weight[inside] * bad[inside])[order]))
            n = np.append(0, np.cumsum((weight[inside] * ~bad[inside])[order]))
            at = np.searchsorted(own[order], cuts, "right")
            for above, p1, n1 in ((False, p[at], n[at]), (True, p[-1] - p[at], n[-1] - n[at])):
                with np.errstate(divide="ignore", invalid="ignore"):
                    own_gain = np.where(p1 > 0, p1 * (np.log2(p1 / (p1 + n1)) - np.log2(p0 / (p0 + n0))), 0)
                k = int(np.argmax(own_gain))
                if own_gain[k] > gain:
                    best, gain = Condition(name, above, float(cuts[k])), own_gain[k]
        if best is None:
            break
        rule.append(best)
        inside &= best.holds(x)
    return rule


def worth(rule: list[Condition], x: dict[str, np.ndarray], bad: np.ndarray, weight: np.ndarray) -> tuple[float, float, int]:
    """(worth when cut back, share of right rejections, bad rows covered) on rows that the rule hasn't grown on."""
    inside = _covered(rule, x, len(bad))
    p, n = weight[inside & bad].sum(), weight[inside & ~bad].sum()
    return (p - n) / max(p + n, 1e-9), p / max(p + n, 1e-9), int((inside & bad).sum())


def learn(x: dict[str, np.ndarray], bad: np.ndarray, weight: np.ndarray, seed: int = 11) -> DecisionList:
    """x: a value of each feature for each row; bad: rows to be rejected; weight: rows of the table that a row stands for."""
    found, left = DecisionList(), np.ones(len(bad), bool)
    luck = np.random.default_rng(seed)
    while len(found.rules) < RULES and (left & bad).sum() >= 2 * LEAST_ROWS:
        held = luck.random(len(bad)) < 1 / 3
        part = lambda own: ({k: v[own] for k, v in x.items()}, bad[own], weight[own])
        grow, prune = part(left & ~held), part(left & held)
        if not grow[1].any() or not prune[1].any():
            break
        rule = grown(*grow)
        cuts = [rule[:k] for k in range(1, len(rule) + 1)]
        if not cuts:
            break
        rule = max(cuts, key=lambda r: (worth(r, *prune)[0], -len(r)))
        _, precision, rows = worth(rule, *prune)
        if precision < LEAST_PRECISION or rows < LEAST_ROWS:
            break
        found.rules.append(rule)
        left &= ~_covered(rule, x, len(bad))
    return found


def training_rows(docs: DataFrame, labels: DataFrame, sample_of_label: int = SAMPLE_OF_LABEL) -> DataFrame:
    """bad, n_of_label and the features of a sample of labelled rows outside the held-out fold that the base lets pass: at most
    sample_of_label of each label, by a hash of doc_id, a row for each id."""
    known = labels.where(F.col("quality").isin(0, 1) & ~in_fold(F.col("doc_id"), FOLD, HELD_OUT)).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    totals = {r.quality: r.n for r in known.groupBy("quality").agg(F.count(F.lit(1)).alias("n")).collect()}
    samples = [bounded_sample(known.where(F.col("quality") == k), sample_of_label, "quality", F.col("doc_id")) for k in (0, 1)]
    sample = F.broadcast(samples[0].unionByName(samples[1]))
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(sample, "doc_id").groupBy("doc_id", "quality").agg(F.min("text").alias("text"))
    rows = texts.select("doc_id", "quality", counted(F.col("text")).alias("counts")).where(~base_failed(F.col("counts")))
    n_of = F.when(F.col("quality") == 0, totals.get(0, 0)).otherwise(totals.get(1, 0)).cast("long")
    return rows.select("doc_id", (F.col("quality") == 0).alias("bad"), n_of.alias("n_of_label"), *[v.alias(k) for k, v in features(F.col("counts")).items()])


def train(docs: DataFrame, labels: DataFrame, sample_of_label: int = SAMPLE_OF_LABEL) -> DecisionList:
    """Without rows of both labels the list is empty, so that every text is kept."""
    rows = training_rows(docs, labels, sample_of_label).orderBy("doc_id").toPandas()
    bad = rows["bad"].to_numpy(bool)
    if not bad.any() or bad.all():
        return DecisionList()
    # the common label is sampled at a lower rate, and a rule's precision is that over the table
    weight = rows["n_of_label"].to_numpy(float) / np.where(bad, bad.sum(), (~bad).sum())
    return learn({k: rows[k].to_numpy(float) for k in rows.columns[3:]}, bad, weight)


def _judged(docs: DataFrame, labels: DataFrame, sample_of_label: int) -> DataFrame:
    """row (all columns), counts, rule (number of the rule that rejects), base_failed, kept."""
    rules = train(docs, labels, sample_of_label)
    rows = docs.select(row_struct(docs.columns), counted(F.col("text")).alias("counts"))
    rows = rows.withColumn("base_failed", base_failed(F.col("counts")))
    rows = rows.withColumn("rule", F.when(~F.col("base_failed"), rules.column(features(F.col("counts")))))
    return rows.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())


def judged(docs: DataFrame, labels: DataFrame, sample_of_label: int = SAMPLE_OF_LABEL) -> DataFrame:
    """doc_id, the counts, base_failed, rule and kept of each document.

    A null or empty text has no words, so it fails the base. Repeated rows are judged alike; a null doc_id has no label;
    labels other than 0 and 1 are left out, and of two labels of one document 0 holds; without both labels the base alone
    decides; an empty table gives no rows; other columns are ignored, whatever their names."""
    rows = _judged(docs.select("doc_id", "text"), labels, sample_of_label)
    return rows.select(F.col("row")["doc_id"].cast("long").alias("doc_id"), *[F.col("counts")[c].alias(c) for c in COUNTS], "base_failed", "rule", "kept")


def accepted(docs: DataFrame, labels: DataFrame, sample_of_label: int = SAMPLE_OF_LABEL) -> DataFrame:
    """docs without those that the base or a rule rejects; odd rows as for judged()."""
    return _judged(docs, labels, sample_of_label).where("kept").select(*row_columns(docs.columns))
