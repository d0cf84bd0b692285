"""URL filter, with DataFrame functions alone: rules by host and path first, else boosted trees over lexical features
(lengths, depth, digit ratio, entropy, parameter counts, suffix statistics), trained from the URLs that rules label."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmine.llm import boosting
from quillmine.llm.common import bounded_sample, lower_ascii

#: (verdict, host and path).
RULES = (("block", "com/en/"), ("allow", "example.com/en/7"), ("allow", "net/de/"), ("block", "example.net/de/8"), ("block", "org/es/"))
#: Rule-labelled URLs that the trees are fitted on at most.
SAMPLE = 10_000
FOLDS = 5
TREES, DEPTH = 25, 3


def _after(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    return F.coalesce(lower_ascii(F.regexp_extract(_after(url), r"^[^/?#]*", 0)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_after(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, text in sorted(rules, key=lambda r: len(r[1])):
        of_host, slash, of_path = text.partition("/")
        fits = ((host == of_host) | host.endswith("." + of_host)) & path.startswith(slash + of_path)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def entropy(text: Column) -> Column:
    """Bits per character of the text's own character frequencies."""
    n = F.length(text)
    share = lambda c: (n - F.length(F.replace(text, c, F.lit("")))) / F.greatest(n, F.lit(1))
    distinct = F.array_distinct(F.filter(F.split(text, ""), lambda c: c != ""))
    return F.aggregate(F.transform(distinct, share), F.lit(0.0), lambda a, p: a - F.when(p > 0, p * F.log2(p)).otherwise(0.0))


def lexical(url: Column, host: Column, path: Column) -> dict[str, Column]:
    url = F.coalesce(url, F.lit(""))
    n = F.length(url)
    count = lambda text, pattern: F.regexp_count(text, F.lit(pattern)).cast("double")
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    return {
        "url_length": n.cast("double"), "host_length": F.length(host).cast("double"), "path_length": F.length(path).cast("double"),
        "host_parts": count(host, r"\."), "depth": count(path, "/"), "hyphens": count(host, "-"),
        "digit_ratio": count(url, "[0-9]") / F.greatest(n, F.lit(1)), "path_digits": count(path, "[0-9]"),
        "entropy": entropy(url), "host_entropy": entropy(host),
        "parameters": F.when(F.length(query) > 0, count(query, "&") + 1).otherwise(F.lit(0.0)), "query_length": F.length(query).cast("double"),
        "fragment": F.contains(url, F.lit("#")).cast("double"), "secure": F.startswith(url, F.lit("https://")).cast("double"), "page_suffix": F.when(F.endswith(path, F.lit("/")), 2.0).otherwise(count(path, r"\.[a-z]+$")),
    }


def suffixes(host: Column, path: Column) -> dict[str, Column]:
    """What statistics are kept of: the host's last label and last two, and the path's first segment."""
    last = lambda n: F.substring_index(host, ".", -n)
    return {"suffix": last(1), "site": last(2), "top": F.regexp_extract(path, r"^/([^/]*)", 1)}


@dataclass
class Model:
    """Trees over the lexical features and, for each suffix, the share of blocked URLs among those that have it."""

    forest: boosting.Forest
    shares: dict[str, dict[str, float]]


def share_tables(suffixes_of: list[dict[str, str]], labels: np.ndarray, weights: np.ndarray) -> dict[str, dict[str, float]]:
    """Weighted share of label 1 of each suffix, drawn to one half as by two rows."""
    found = {}
    for name in suffixes_of[0] if suffixes_of else ():
        keys, place = np.unique([o[name] for o in suffixes_of], return_inverse=True)
        blocked, all_ = np.bincount(place, labels * weights), np.bincount(place, weights)
        found[name] = dict(zip(keys.tolist(), ((blocked + 1.0) / (all_ + 2.0)).tolist()))
    return found


def train(pages: DataFrame, rules=RULES, sample: int = SAMPLE) -> Model:
    """From at most `sample` rule-labelled URLs, taken by a hash. Both verdicts weigh alike. A URL's own label is not in the
    shares it is trained with: these come from the other folds, dealt by a hash of the host, so a host says nothing of itself."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"))
    rows = rows.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
    ruled = matching_rule(F.col("host"), F.col("path"), rules)[1]
    features, opened = lexical(F.col("url"), F.col("host"), F.col("path")), suffixes(F.col("host"), F.col("path"))
    labelled = bounded_sample(rows.withColumn("ruled", ruled).where(F.col("ruled").isNotNull()), sample, "urls", F.col("url"), F.col("page_id"))
    fold = F.pmod(F.xxhash64(F.lit("fold"), "host"), F.lit(FOLDS)).cast("int")
    known = [r.asDict() for r in labelled.select(fold.alias("fold"), (F.col("ruled") == "block").cast("double").alias("label"), *[c.alias(n) for n, c in (features | opened).items()]).toLocalIterator()]
    if not known:
        return Model(boosting.Forest(-math.log(99)), {})
    labels, folds = np.array([r["label"] for r in known]), np.array([r["fold"] for r in known])
    of_label = np.array([(labels == k).sum() for k in (0, 1)])
    weights = len(known) / 2 / of_label[labels.astype(int)]
    own = [{n: r[n] for n in opened} for r in known]
    shares = np.full((len(known), len(opened)), 0.5)
    for k in range(FOLDS):
        others = np.flatnonzero(folds != k)
        tables = share_tables([own[i] for i in others], labels[others], weights[others])
        for i in np.flatnonzero(folds == k):
            shares[i] = [tables[n].get(own[i][n], 0.5) if tables else 0.5 for n in opened]
    x = np.concatenate([np.array([[r[n] for n in features] for r in known]), shares], axis=1)
    return Model(boosting.train(x, labels, TREES, DEPTH, weight=weights), share_tables(own, labels, weights))


def judged(pages: DataFrame, rules=RULES, sample: int = SAMPLE, model: Model | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict, score (the trees' probability of block) of each page.

    A null URL and one without :// have empty host and path, fit no rule, and are judged by their features like any other.
    The trees learn from at most `sample` rule-labelled URLs, taken by a hash. If these are all of one verdict, or there are
    none, that verdict or allow holds for the rest. A null page_id and repeated rows are kept; an empty table gives no rows;
    other columns are ignored.
    """
    model = model or train(pages, rules, sample)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"))
    rows = rows.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    rows = rows.withColumn("rule", rule).withColumn("ruled", verdict)
    features, opened = lexical(F.col("url"), F.col("host"), F.col("path")), suffixes(F.col("host"), F.col("path"))
    for name, of in opened.items():
        # these tables have at most as many rows as the sample
        table = pages.sparkSession.createDataFrame(sorted(model.shares.get(name, {}).items()), f"{name} string, {name}_share double")
        rows = rows.withColumn(name, of).join(F.broadcast(table), name, "left").withColumn(f"{name}_share", F.coalesce(f"{name}_share", F.lit(0.5)))
    shares = [f"{name}_share" for name in opened]
    valued = rows.select("page_id", "host", "path", "rule", "ruled", *[c.alias(n) for n, c in features.items()], *shares)
    margin = model.forest.column([F.col(n) for n in (*features, *shares)])
    valued = valued.withColumn("score", 1 / (1 + F.exp(-margin)))
    return valued.select("page_id", "host", "path", "rule", F.coalesce("ruled", F.when(F.col("score") >= 0.5, "block").otherwise("allow")).alias("verdict"), "score")
