"""Personal data: fixed patterns first, then candidate spans judged by boosted trees.

Four kinds have patterns whose matches always count. High-recall generators propose more spans, which may overlap: looser
spellings of addresses, and every stretch of groups of digits that could be a number. Boosted trees judge them by format and
by context; they are trained on spans of a bounded sample of texts that the patterns decide, and on those spans rewritten
in looser spellings, beside stretches of digits that the patterns refuse. Each kind's threshold is calibrated on texts left
out of training.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmine.llm import boosting
from quillmine.llm.common import bounded_sample, give_back_memory, row_columns, row_struct

KINDS = ("email", "ip", "card", "phone")
#: Texts that the trees learn from at most, and candidates taken from them at most.
SAMPLE_TEXTS, SAMPLE_SPANS = 5000, 20_000
PRECISION, FOLDS = 0.995, 4
TREES, DEPTH = 40, 3
#: Candidates whose features are held at once.
AT_ONCE = 1 << 14

_DIGIT = re.compile("[0-9]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
#: A match never starts inside a run of digits: what fails from its first digit fails from the others as well.
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = int(d) * (1 + k % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches of [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+ in time linear in the text:
    each @ is met once, and the run before it is read backwards to the last match's end."""
    found, cursor, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > cursor and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            found.append((start, match.end()))
            cursor = match.end()
        at = text.find("@", max(at + 1, cursor))
    return found


def ips(text: str) -> list[tuple[int, int]]:
    small = lambda part: len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255
    return [m.span() for m in _IP.finditer(text) if all(map(small, m.group().split(".")))]


def cards(text: str) -> list[tuple[int, int]]:
    found = []
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m.group().replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                found.append(m.span())
    return found


def phones(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _PHONE.finditer(text) if 9 <= len(_DIGIT.findall(m.group())) <= 15]


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    """By kind as listed, then start; code points, end exclusive."""
    if not text:
        return []
    digits = _DIGIT.search(text) is not None
    found = [("email", emails(text)), ("ip", ips(text) if digits and "." in text else []), ("card", cards(text) if digits else []), ("phone", phones(text) if digits and "+" in text else [])]
    return [(kind, a, b) for kind, spans in found for a, b in spans]


_LOOSE_AT = re.compile(r" ?(?:\(at\)|\[at\]|\{at\}) ?[A-Za-z0-9-]+(?:(?:\.| ?(?:\(dot\)|\[dot\]|\{dot\}) ?| dot )[A-Za-z0-9-]+)+| at [A-Za-z0-9-]+(?: dot [A-Za-z0-9-]+)+|＠[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", re.I)
_LOOSE_IP = re.compile(r"(?<![0-9])[0-9]{1,3}(?:(?: ?(?:\[\.\]|\(\.\)|\[dot\]|\(dot\)) ?| dot )[0-9]{1,3}){3}(?![0-9])", re.I)
_RUN = re.compile(r"[0-9]+(?:[\x20().\-/‐-–]{1,3}[0-9]+)*")
_GROUP = re.compile("[0-9]+")
#: Digits that a number has at most, and code points that it takes at most: a run is read from each of its groups up to these.
MOST_DIGITS, MOST_LENGTH = 19, 48


def number_candidates(text: str) -> list[tuple[str, int, int]]:
    """From each run of groups of digits all stretches of whole groups that could be a number of some kind: so of two numbers
    side by side each is proposed, and so is what stands beside a pattern's span."""
    found = []
    for run in _RUN.finditer(text):
        if run.end() - run.start() < 7:
            continue
        groups = [m.span() for m in _GROUP.finditer(text, run.start(), run.end())]
        for k, (start, _) in enumerate(groups):
            signed = start
            for shift in (1, 2):  # an opening bracket or plus sign belongs to the number
                if start >= shift and text[start - shift : start] in ("+", "(", "+("):
                    signed = start - shift
                    break
            n = 0
            for j in range(k, len(groups)):
                end = groups[j][1]
                n += end - groups[j][0]
                if n > MOST_DIGITS or end - start > MOST_LENGTH:
                    break
                if 9 <= n <= 15 or 7 <= n <= 8 and signed < start:
                    found.append(("phone", signed, end))
                if 13 <= n:
                    found.append(("card", start, end))
                if j - k == 3 and text.count(".", start, end) == 3:
                    found.append(("ip", start, end))
    return found


def candidates(text: str | None) -> list[tuple[str, int, int]]:
    """High recall: (kind, start, end), which may overlap each other."""
    if not text:
        return []
    found = [("ip", *m.span()) for m in _LOOSE_IP.finditer(text)] if ("." in text or "dot" in text) and _DIGIT.search(text) else []
    if "at" in text or "AT" in text or "At" in text or "aT" in text or "＠" in text:
        for m in _LOOSE_AT.finditer(text):
            start = m.start()
            while start > 0 and text[start - 1] in _LOCAL and m.start() - start < 64:
                start -= 1
            if start < m.start():
                found.append(("email", start, m.end()))
    if _DIGIT.search(text):
        found += number_candidates(text)
    return found


_HINTS = {"email": ("mail", "contact", "write"), "ip": ("ip", "host", "addr"), "card": ("card", "visa", "credit"), "phone": ("tel", "phone", "call", "fax", "mobil")}
FEATURES = (
    "email", "ip", "card", "phone", "length", "digits", "digit_share", "groups", "longest_group", "shortest_group", "dots", "hyphens", "spaces", "brackets", "slashes", "plus", "luhn",
    "octets", "leading_zero", "distinct_digits", "domain_parts", "top_level", "hint_before", "word_before", "word_after", "digit_before", "digit_after", "letter_after", "quote_around", "line_start",
)


def features(text: str, kind: str, start: int, end: int) -> list[float]:
    """Format of the span, and what stands within 24 characters around it."""
    span, before, after = text[start:end], text[max(0, start - 24) : start], text[end : end + 24]
    groups = re.findall("[0-9]+", span)
    digits = "".join(groups)
    lengths = [len(g) for g in groups] or [0]
    parts = re.split(r"\.|dot", span.lower())
    return [
        *(float(kind == k) for k in KINDS), len(span), len(digits), len(digits) / max(1, len(span)), len(groups), max(lengths), min(lengths), span.count("."), span.count("-"), span.count(" "),
        span.count("(") + span.count(")"), span.count("/"), float(span.startswith("+")), float(13 <= len(digits) <= 19 and luhn(digits)),
        float(len(groups) == 4 and all(len(g) <= 3 and int(g) <= 255 for g in groups)), float(digits.startswith("0")), len(set(digits)), len(parts), len(parts[-1].strip(" ()[]{}")),
        float(any(h in before.lower() for h in _HINTS[kind])), float(before[-1:].isalpha()), float(after[:1].isalpha()), float(before[-1:].isdigit() or before[-2:-1].isdigit()),
        float(after[:1].isdigit() or after[1:2].isdigit()), float(after[1:2].isalpha()), float(before[-1:] in "\"'=" and before != ""), float(before == "" or before.endswith("\n")),
    ]


def spellings(kind: str, span: str) -> list[str]:
    """A pattern's span in looser spellings."""
    digits = re.sub("[^0-9]", "", span)
    if kind == "email":
        local, _, domain = span.partition("@")
        return [f"{local} (at) {domain}", f"{local}[at]{domain.replace('.', '[dot]')}", f"{local} at {domain.replace('.', ' dot ')}", f"{local}＠{domain}", f"{local} (at) {domain.replace('.', ' (dot) ')}"]
    if kind == "card":
        return [sep.join(digits[k : k + 4] for k in range(0, len(digits), 4)) for sep in ("/", ".", "–", " - ")]
    if kind == "ip":
        return [sep.join(span.split(".")) for sep in ("[.]", " . ", "(dot)", "[dot]")]
    forms = [span.replace(" ", "/"), span.replace("-", "–"), "(" + span.lstrip("+"), f"00{digits[:2]} {digits[2:4]} {digits[4:8]} {digits[8:]}".strip(), f"(0{digits[2:4]}) {digits[4:8]}-{digits[8:] or digits[:2]}"]
    return [f for f in forms if f != span and f.count("(") <= 2]


def loosened(text: str, kind: str, start: int, end: int, luck: int | None = None, left_out: int | None = None) -> list[tuple[str, str, int, int]]:
    """A pattern's span in its looser spellings, or in one of them by luck, each as (text around it, kind, start, end). left_out:
    the number of a spelling that is not used, so that it can be measured unseen."""
    forms = [f for k, f in enumerate(spellings(kind, text[start:end])) if k != left_out]
    if luck is not None:
        forms = forms[luck % len(forms) :][:1] if forms else []
    before, after = text[max(0, start - 24) : start], text[end : end + 24]
    return [(before + form + after, kind, len(before), len(before) + len(form)) for form in forms]


class Model:
    """Trees, and of each kind the least probability that selects a span (above 1: none is)."""

    def __init__(self, forest: boosting.Forest, thresholds: dict[str, float]):
        self.forest, self.thresholds = forest, thresholds

    def spans(self, text: str | None) -> list[tuple[str, int, int]]:
        """The patterns' spans, and the candidates that the trees accept and no other span overlaps, best first, of equal
        ones the longest."""
        base = base_spans(text)
        kept = list(base)
        taken = united(base)
        proposed = [c for c in candidates(text) if self.thresholds.get(c[0], 2.0) <= 1 and not overlaps(taken, c)]
        if proposed:
            p = np.concatenate([self.forest.probability(np.array([features(text, *c) for c in proposed[at : at + AT_ONCE]], np.float64)) for at in range(0, len(proposed), AT_ONCE)])
            least = np.array([self.thresholds[kind] for kind, *_ in proposed])
            length = np.array([b - a for _, a, b in proposed])
            for k in np.lexsort((-length, -p)):
                if p[k] >= least[k] and not overlaps(taken, proposed[k]):
                    kept.append(proposed[k])
                    insort(taken, proposed[k][1:])
        return sorted(kept, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def united(spans: list[tuple[str, int, int]]) -> list[tuple[int, int]]:
    """The stretches that spans take together, in order; patterns of two kinds may overlap each other."""
    found: list[tuple[int, int]] = []
    for a, b in sorted((a, b) for _, a, b in spans):
        if found and a < found[-1][1]:
            found[-1] = found[-1][0], max(b, found[-1][1])
        else:
            found.append((a, b))
    return found


def overlaps(taken: list[tuple[int, int]], span: tuple[str, int, int]) -> bool:
    """taken: stretches in order that don't overlap each other, so the last one that begins before the span's end decides."""
    _, start, end = span
    at = bisect_left(taken, (end, 0))
    return at > 0 and taken[at - 1][1] > start


def examples(text: str, left_out: int | None = None) -> list[tuple[str, list[float], int, bool]]:
    """Labelled candidates of one text, as (kind, features, label, whether it is a looser one): what a pattern takes is personal
    data and so is its looser spelling; what the patterns refuse is not, unless a word before it hints at its kind: that is
    left out, as nothing decides it."""
    base = base_spans(text)
    taken = united(base)
    out = []
    for kind, start, end in base:
        for around, k, a, b in loosened(text, kind, start, end, None, left_out):
            out.append((k, features(around, k, a, b), 1, True))
            # parts of a number are not the number
            out += [(k2, features(around, k2, a2, b2), 0, True) for k2, a2, b2 in candidates(around) if (k2, a2, b2) != (k, a, b) and a <= a2 and b2 <= b]
        out.append((kind, features(text, kind, start, end), 1, False))
    hinted = FEATURES.index("hint_before")
    for c in candidates(text):
        if not overlaps(taken, c):
            x = features(text, *c)
            if not x[hinted]:
                out.append((c[0], x, 0, True))
    return out


def example_rows(docs: DataFrame, sample_texts: int = SAMPLE_TEXTS, sample_spans: int = SAMPLE_SPANS) -> DataFrame:
    """kind, x, y, loose, fold of at most sample_spans candidates, taken by a hash, from at most sample_texts texts, taken by a
    hash. fold follows the text: what is learned from one is never measured on it."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sample = bounded_sample(texts, sample_texts, "pii", F.col("doc_id"))

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for text in batch["text"]:
                found = examples(text) if text else []
                if found:  # an empty column would have no type that Arrow takes for lists
                    kinds, x, y, loose = zip(*found)
                    yield pd.DataFrame({"kind": kinds, "x": x, "y": y, "loose": loose, "fold": zlib.crc32(text.encode("utf-8", "surrogatepass")) % FOLDS})

    found = sample.mapInPandas(rows, "kind string, x array<double>, y int, loose boolean, fold int")
    return found.orderBy(F.xxhash64("x", "y"), "kind", "y", "fold").limit(sample_spans)


def fit(rows: list[tuple[str, tuple[float, ...], int, bool, int]], left_out: int = 0, precision: float = PRECISION) -> Model:
    """rows: (kind, features, label, loose, fold). Trees from the folds but one; each kind's threshold from that one's looser
    spans: the least that keeps the precision."""
    rows = sorted(rows)
    if not rows:
        return Model(boosting.Forest(0.0), {})
    kinds, loose, folds = np.array([r[0] for r in rows]), np.array([r[3] for r in rows]), np.array([r[4] for r in rows])
    x, y = np.array([r[1] for r in rows]), np.array([r[2] for r in rows], np.float64)
    forest = boosting.train(x[folds != left_out], y[folds != left_out], TREES, DEPTH)
    thresholds = {}
    for kind in KINDS:
        of = (folds == left_out) & (kinds == kind) & loose
        if y[of].any():
            thresholds[kind] = max(0.5, boosting.cut_for_precision(forest.probability(x[of]), y[of], precision))
    return Model(forest, thresholds)


def train(docs: DataFrame, sample_texts: int = SAMPLE_TEXTS) -> Model:
    """From a bounded sample of candidates' features, which come to the driver."""
    return fit([(r.kind, tuple(r.x), r.y, r.loose, r.fold) for r in example_rows(docs, sample_texts).toLocalIterator()])


def span_text(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind, a, b in spans)


def redacted(text: str | None, spans: list[tuple[str, int, int]]) -> str | None:
    """text with each span replaced by its kind in brackets; of overlapping spans, one bracket for their union, named by the first."""
    if text is None or not spans:
        return text
    out, at = [], 0
    merged: list[list] = []
    for kind, a, b in sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]))):
        if merged and a < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], b)
        else:
            merged.append([kind, a, b])
    for kind, a, b in merged:
        out += [text[at:a], f"[{kind.upper()}]"]
        at = b
    return "".join([*out, text[at:]])


def _shared(docs: DataFrame, model: Model | None):
    return docs.sparkSession.sparkContext.broadcast(model or train(docs))


def span_column(text: Column, shared) -> Column:
    """struct: n_email, n_ip, n_card, n_phone and base_sha256 of the patterns' spans; spans, all of them."""

    @F.pandas_udf("n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans array<struct<kind:string,start:int,end:int>>")
    def find(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            base = base_spans(text)
            rows.append((*(sum(k == kind for k, *_ in base) for kind in KINDS), hashlib.sha256(span_text(base).encode()).hexdigest(), [{"kind": k, "start": a, "end": b} for k, a, b in shared.value.spans(text)]))
        give_back_memory()
        return pd.DataFrame(rows, columns=["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])

    return find(text)


def personal_data(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans (array of kind, start, end) of each document.

    Null text counts as empty: no spans. A null doc_id and repeated rows are kept; an empty table gives no rows and learns
    nothing, so only the patterns would count; other columns are ignored. Offsets are code points.
    """
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), span_column(F.col("text").cast("string"), _shared(docs, model)).alias("found"))
    return found.select("doc_id", "found.*")


def spans_as_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def without_personal_data(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """docs with every span replaced by its kind in brackets, and n_chars set anew where that column exists and text changed. A
    null text stays null and an empty one empty; repeated rows are kept and changed alike; an empty table gives no rows; other
    columns may have any names and are kept."""
    shared = _shared(docs, model)

    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        found = pd.Series([redacted(x, shared.value.spans(x)) for x in texts], dtype="object")
        give_back_memory()
        return found

    names = docs.columns
    rows = docs.select(row_struct(names), clean(F.col("text").cast("string")).alias("cleaned"))
    new = {"text": F.col("cleaned")}
    if "n_chars" in names:
        same = F.col("row").getField("text").eqNullSafe(F.col("cleaned"))
        new["n_chars"] = F.when(same, F.col("row").getField("n_chars")).otherwise(F.length("cleaned")).cast(docs.schema["n_chars"].dataType)
    return rows.select(*[new[c].alias(c) if c in new else row_columns([c])[0] for c in names])
