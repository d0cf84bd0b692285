"""Language identification by a bidirectional gated recurrent network over bytes.

A text's UTF-8 bytes are cut into windows. In each, one recurrent cell reads forwards and one backwards; their states
label every byte, and a document's probabilities are the mean over its letters' bytes. The network is trained in numpy
by backpropagation through time on windows of a bounded sample of labelled documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillmine.llm.common import give_back_memory, in_fold

WINDOW = 64
#: Hidden units of a direction: eight, and eight more for each eightfold number of languages.
HIDDEN, MOST_HIDDEN = 8, 32
#: Languages that are learned at most: those with the most documents.
MOST_LANGUAGES = 2000
#: Documents of each language that are learned from at most, and windows of each.
DOCS_OF_LANGUAGE, WINDOWS_OF_DOC = 250, 4
STEPS, BATCH, RATE = 220, 192, 0.02
#: Windows that are read side by side.
AT_ONCE = 2048
FOLD, HELD_OUT = 4, 2
LETTER = regex.compile(r"\p{L}")
_ASCII_LETTER = np.array([b < 128 and chr(b).isalpha() for b in range(256)])


@cache
def _letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def letter_bytes(text: str, data: bytes) -> np.ndarray:
    """Which of the text's bytes belong to letters."""
    if len(data) == len(text):
        return _ASCII_LETTER[np.frombuffer(data, np.uint8)]
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.repeat(_letters()[points], 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF))


def windows(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of each window, filled with zeros; lengths)."""
    n = -(-len(data) // WINDOW)
    flat = np.zeros(n * WINDOW, np.uint8)
    flat[: len(data)] = np.frombuffer(data, np.uint8)
    lengths = np.full(n, WINDOW)
    if n:
        lengths[-1] = len(data) - (n - 1) * WINDOW
    return flat.reshape(n, WINDOW), lengths


def hidden_units(n_labels: int) -> int:
    return min(MOST_HIDDEN, HIDDEN * max(1, int(np.ceil(np.log2(max(2, n_labels)) / 3))))


def start(n_labels: int, seed: int = 7) -> dict[str, np.ndarray]:
    """Axis 0 is the direction: forwards, backwards. Gates lie side by side: update, reset, new state."""
    r = np.random.default_rng(seed)
    h = hidden_units(n_labels)
    return {
        "in": r.normal(0, 0.3, (2, 256, 3 * h)), "gates": r.normal(0, h**-0.5, (2, h, 2 * h)), "new": r.normal(0, h**-0.5, (2, h, h)),
        "out": r.normal(0, 0.3, (2, h, n_labels)), "bias": np.zeros(n_labels),
    }


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def loss_and_slopes(p: dict[str, np.ndarray], batch: np.ndarray, mask: np.ndarray, labels: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean cross entropy over labelled positions, and its slopes by backpropagation through time. batch, mask: (n, steps)."""
    n, steps = batch.shape
    h = p["new"].shape[1]
    ways = [np.arange(steps), np.arange(steps)[::-1]]
    states, kept = np.zeros((2, steps, n, h)), []
    before = np.zeros((2, n, h))
    for k in range(steps):
        now = [w[k] for w in ways]
        x = np.stack([p["in"][d][batch[:, now[d]]] for d in (0, 1)])
        gates = _sigmoid(x[:, :, : 2 * h] + before @ p["gates"])
        update, reset = gates[:, :, :h], gates[:, :, h:]
        inner = before @ p["new"]
        new = np.tanh(x[:, :, 2 * h :] + reset * inner)
        live = np.stack([mask[:, now[d]] for d in (0, 1)])[:, :, None]
        after = np.where(live, (1 - update) * new + update * before, before)
        kept.append((now, before, update, reset, inner, new, live))
        for d in (0, 1):
            states[d, now[d]] = after[d]
        before = after
    logits = states[0] @ p["out"][0] + states[1] @ p["out"][1] + p["bias"]
    logits -= logits.max(axis=2, keepdims=True)
    odds = np.exp(logits)
    odds /= odds.sum(axis=2, keepdims=True)
    weight = mask.T / max(1, mask.sum())
    true = odds[:, np.arange(n), labels]
    loss = float(-(weight * np.log(true + 1e-12)).sum())
    error = odds
    error[:, np.arange(n), labels] -= 1
    error *= weight[:, :, None]
    slopes = {k: np.zeros_like(v) for k, v in p.items()}
    slopes["bias"] = error.sum(axis=(0, 1))
    back = np.zeros_like(states)
    for d in (0, 1):
        slopes["out"][d] = np.einsum("tnh,tnl->hl", states[d], error)
        back[d] = error @ p["out"][d].T
    flowing = np.zeros((2, n, h))
    for now, before, update, reset, inner, new, live in reversed(kept):
        total = flowing + np.stack([back[d, now[d]] for d in (0, 1)])
        inside = np.where(live, total, 0)
        to_new = inside * (1 - update) * (1 - new**2)
        to_update = inside * (before - new) * update * (1 - update)
        to_reset = to_new * inner * reset * (1 - reset)
        to_gates = np.concatenate([to_update, to_reset], axis=2)
        to_inner = to_new * reset
        to_x = np.concatenate([to_gates, to_new], axis=2)
        for d in (0, 1):
            np.add.at(slopes["in"][d], batch[:, now[d]], to_x[d])
        slopes["gates"] += before.transpose(0, 2, 1) @ to_gates
        slopes["new"] += before.transpose(0, 2, 1) @ to_inner
        flowing = np.where(live, inside * update + to_gates @ p["gates"].transpose(0, 2, 1) + to_inner @ p["new"].transpose(0, 2, 1), total)
    return loss, slopes


def train_network(examples: list[tuple[bytes, int]], n_labels: int, steps: int = STEPS) -> dict[str, np.ndarray]:
    """examples: (bytes of at most one window, label). Every label is drawn alike often."""
    p = start(n_labels)
    r = np.random.default_rng(11)
    by_label = [[x for x, y in examples if y == k] for k in range(n_labels)]
    first, second = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    for step in range(1, steps + 1):
        labels = r.integers(0, n_labels, BATCH)
        batch, mask = np.zeros((BATCH, WINDOW), np.uint8), np.zeros((BATCH, WINDOW), bool)
        for k, label in enumerate(labels):
            data = by_label[label][r.integers(len(by_label[label]))]
            batch[k, : len(data)] = np.frombuffer(data, np.uint8)
            mask[k, : len(data)] = True
        _, slopes = loss_and_slopes(p, batch, mask, labels)
        for k in p:
            first[k] = 0.9 * first[k] + 0.1 * slopes[k]
            second[k] = 0.99 * second[k] + 0.01 * slopes[k] ** 2
            p[k] = p[k] - RATE * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
    return p


class Model:
    def __init__(self, languages: list[str], p: dict[str, np.ndarray] | None):
        self.languages = languages
        self.p = p and {k: v.astype(np.float32) for k, v in p.items()}

    def read(self, batch: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Probabilities of the labels at every position: (windows, WINDOW, labels)."""
        p, (n, steps), h = self.p, batch.shape, self.p["new"].shape[1]
        part = np.any(lengths < steps)
        states = np.empty((2, steps, n, h), np.float32)
        # a sigmoid is a tanh of half its argument
        table = p["in"].copy()
        table[:, :, : 2 * h] *= 0.5
        both = np.concatenate([p["gates"] * 0.5, p["new"]], axis=2)
        for d in (0, 1):
            state, columns = np.zeros((n, h), np.float32), np.ascontiguousarray(batch.T)
            for k in range(steps) if d == 0 else range(steps - 1, -1, -1):
                x = table[d].take(columns[k], axis=0)
                from_state = state @ both[d]
                gates = np.tanh(x[:, : 2 * h] + from_state[:, : 2 * h])
                gates *= 0.5
                gates += 0.5
                new = from_state[:, 2 * h :]
                new *= gates[:, h:]
                new += x[:, 2 * h :]
                np.tanh(new, out=new)
                after = state - new
                after *= gates[:, :h]
                after += new
                if part:
                    after = np.where((k < lengths)[:, None], after, state)
                states[d, k] = state = after
        logits = states[0].reshape(-1, h) @ p["out"][0] + states[1].reshape(-1, h) @ p["out"][1] + p["bias"]
        np.exp(logits - logits.max(axis=1, keepdims=True), out=logits)
        logits /= logits.sum(axis=1, keepdims=True)
        return logits.reshape(steps, n, -1).transpose(1, 0, 2)

    def pooled(self, texts: list[str]) -> np.ndarray:
        """Mean probabilities of each text over its letters' bytes. Windows of all texts are read together."""
        out = np.zeros((len(texts), len(self.languages)))
        if not texts or not self.languages:
            return out
        if len(self.languages) == 1:
            return out + 1.0
        weight = np.zeros(len(texts))
        held, size = [], 0

        def settle():
            nonlocal held, size
            batch, lengths, counted = (np.concatenate(x) for x in zip(*(x for _, *x in held)))
            owner = np.repeat([k for k, *_ in held], [len(x) for _, x, *_ in held])
            short = lengths < WINDOW
            for which in (np.flatnonzero(~short), np.flatnonzero(short)):
                for at in range(0, len(which), AT_ONCE):
                    w = which[at : at + AT_ONCE]
                    odds = self.read(batch[w], lengths[w])
                    # not optimize: the mask as a product keeps it within one pass
                    np.add.at(out, owner[w], np.einsum("ntl,nt->nl", odds, counted[w].astype(np.float32)))
            np.add.at(weight, owner, counted.sum(axis=1, dtype=np.int64))
            held, size = [], 0

        for k, text in enumerate(texts):
            data = text.encode("utf-8", "surrogatepass")
            letters = letter_bytes(text, data)
            for at in range(0, len(data), AT_ONCE * WINDOW):
                x, lengths = windows(data[at : at + AT_ONCE * WINDOW])
                held.append((k, x, lengths, windows(letters[at : at + AT_ONCE * WINDOW].tobytes())[0]))
                size += len(x)
                if size >= 4 * AT_ONCE:
                    settle()
        if held:
            settle()
        return out / np.maximum(weight, 1)[:, None]

    def predict(self, texts) -> list[tuple[str, float]]:
        """(language, probability) per text; `und` and 0 for null and for texts without a letter."""
        readable = [k for k, x in enumerate(texts) if x and LETTER.search(x)]
        result: list[tuple[str, float]] = [("und", 0.0)] * len(texts)
        if not self.languages or not readable:
            return result
        place: dict[str, int] = {}
        index = [place.setdefault(texts[k], len(place)) for k in readable]
        odds = self.pooled(list(place))
        for k, i in zip(readable, index):
            best = int(odds[i].argmax())
            result[k] = self.languages[best], float(min(1.0, odds[i, best]))
        return result


def training_windows(docs: DataFrame, docs_of_language: int = DOCS_OF_LANGUAGE) -> DataFrame:
    """(lang, piece): stretches of texts at pseudorandom places, from docs_of_language different documents (id and text) of each
    language outside the held-out fold (all, where there are fewer). Every language is learned, however rare and however often
    its rows repeat an id; beyond MOST_LANGUAGES those with the most documents. Only stretches are ordered and gathered, so the
    sample takes at most docs_of_language * WINDOWS_OF_DOC * WINDOW characters a language."""
    named = docs.select(F.col("lang").cast("string").alias("lang"), "doc_id", F.col("text").cast("string").alias("text")).where(F.col("lang").isNotNull() & ~in_fold(F.col("doc_id"), FOLD, HELD_OUT))
    usable = named.where(F.col("text").rlike(r"\p{L}")).withColumn("key", F.xxhash64(F.lit("language"), "doc_id", "text"))
    # different documents are counted, about; the margin is far wider than the count's error, and equal rows are one below
    counted = usable.groupBy("lang").agg(F.approx_count_distinct("key", 0.02).alias("n")).orderBy(F.col("n").desc(), "lang").limit(MOST_LANGUAGES)
    share = F.broadcast(counted.select("lang", (F.lit(4.0 * docs_of_language * (1 << 20)) / F.col("n")).alias("share")))
    luck = F.pmod("key", F.lit(1 << 20))
    drawn = usable.join(share, "lang").where(luck < F.col("share"))
    at = lambda k: F.pmod(F.xxhash64(F.lit("window"), F.col("key"), k), F.greatest(F.lit(1), F.length("text") - WINDOW)) + 1
    pieces = F.transform(F.sequence(F.lit(1), F.lit(WINDOWS_OF_DOC)), lambda k: F.substring(F.col("text"), at(k).cast("int"), F.lit(WINDOW)))
    drawn = drawn.select("lang", "key", pieces.alias("pieces")).groupBy("lang", "key").agg(F.min("pieces").alias("pieces"))
    first = F.row_number().over(Window.partitionBy("lang").orderBy(F.pmod("key", F.lit(1 << 20)), "key"))
    return drawn.withColumn("place", first).where(F.col("place") <= docs_of_language).select("lang", F.explode("pieces").alias("piece"))


def train(docs: DataFrame, docs_of_language: int = DOCS_OF_LANGUAGE) -> Model:
    rows = sorted((r.lang, r.piece.encode("utf-8", "surrogatepass")[:WINDOW]) for r in training_windows(docs, docs_of_language).toLocalIterator() if r.piece)
    languages = sorted({lang for lang, _ in rows})
    if len(languages) < 2:
        return Model(languages, None)
    place = {x: k for k, x in enumerate(languages)}
    return Model(languages, train_network([(data, place[lang]) for lang, data in rows], len(languages)))


def identified(docs: DataFrame, docs_of_language: int = DOCS_OF_LANGUAGE) -> DataFrame:
    """doc_id, held_out, lang_pred, score of each document.

    `und` and 0 for a null text and for one without a letter. Rows without lang are only predicted; a null doc_id counts
    as held out; repeated rows get equal results; with one language in training every text with a letter is in it, with
    none every text is `und`; an empty table gives no rows; other columns are ignored, whatever their names.
    """
    model = docs.sparkSession.sparkContext.broadcast(train(docs, docs_of_language))

    def predict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 2000):
                part = batch.iloc[at : at + 2000]
                found = model.value.predict(part["text"].tolist())
                yield pd.DataFrame({"doc_id": part["doc_id"].to_numpy(), "held_out": part["held_out"].to_numpy(), "lang_pred": [x for x, _ in found], "score": [y for _, y in found]})
        give_back_memory()

    # doc_id crosses Python as text: beside nulls pandas would hold it as a float
    rows = docs.select(F.col("doc_id").cast("long").cast("string").alias("doc_id"), in_fold(F.col("doc_id"), FOLD, HELD_OUT).alias("held_out"), F.col("text").cast("string").alias("text"))
    return rows.mapInPandas(predict, "doc_id string, held_out boolean, lang_pred string, score double").withColumn("doc_id", F.col("doc_id").cast("long"))
