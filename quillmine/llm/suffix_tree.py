"""Language-model scoring by a probabilistic suffix tree.

A text's words, joined by single spaces and ended by an end mark, are a sequence of symbols: every byte
that UTF-8 text in lower case can hold is one. All training texts' counts of a symbol with the symbols before it give contexts of length 0 to DEPTH. A
context is a state of the tree if it occurs LEAST_COUNT times, at any size of the corpus, and its next-symbol distribution
diverges enough from that of its longest suffix in the tree. A state's distribution is smoothed with its suffix's in
proportion to its number of different symbols. Each symbol is scored by the state that is the longest suffix of what
stands before it.

The tree grows with the corpus, so it is never whole in one place. Contexts up to NEAR symbols, as many as the alphabet
allows, are a head that every task has. Longer ones are dealt out by their KEYED nearest symbols: all suffixes of a context
that the head lacks are in its part, so each part grows by itself. The unigram score over words lies beside it; words and
their counts are dealt out over the same parts by a hash. A chunk of texts asks each part for its own different codes and
words, and gets their probabilities and counts. Codes, words and counts travel as compressed columns, a row for each chunk
and part.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmine.llm.common import give_back_memory, in_fold, stored

BITS, DEPTH = 8, 6
PLAIN = b"abcdefghijklmnopqrstuvwxyz 0123456789.,;:!?'\"()-_/@#%&=+*|"
LEAST_COUNT = 2
#: Nats by which a context's counts must be likelier under its own distribution than under its suffix's.
DIVERGENCE = 5.0
SMOOTHING = 0.1
#: Bytes of text that are coded at once, that a chunk holds about, and counts and words that a task holds before it passes them on.
PART, CHUNK_BYTES, HELD, WORDS_HELD = 1 << 21, 1 << 24, 3 << 20, 1 << 20
#: Bytes of text whose counts a task sums up before it passes them on: more of them, fewer rows to shuffle.
COUNTED_BYTES = 64 << 20
#: Length of the contexts that every task has, and symbols by which longer ones are dealt out.
NEAR, KEYED = 2, 3
#: Bytes of text for each part of the tree, and codes in a row of a part.
BYTES_A_PART, CODES_A_ROW = 1 << 25, 1 << 18
#: Rows whose codes are made together; rows and bytes of text that are packed into one stretch about.
ROWS_AT_ONCE, STRETCH_ROWS, STRETCH_BYTES = 1000, 250, 1 << 19
#: Texts in a part; with DEPTH + 1 symbols their number fits one 64-bit word.
TEXTS = 1 << 7
FOLD, HELD_OUT = 10, 0

#: Bytes that no word has: white space, letters that are made small, and what UTF-8 never uses. They share the last symbol.
NEVER = {*range(9, 14), *b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", 0xC0, 0xC1, *range(0xF5, 0x100)}
END, ESCAPE = 0, 255
_KNOWN = [*PLAIN, 0xC2, 0xC3, *range(0x80, 0xC0), *b"$[]{}<>\\^~`"]
_KNOWN += [b for b in range(256) if b not in {*_KNOWN} | NEVER]
SYMBOL = bytes(ESCAPE if b in NEVER else _KNOWN.index(b) + 1 for b in range(256))
ESCAPED = len(NEVER)
#: Symbols that are smoothed in full; the others share one's smoothing.
SMOOTHED = 128


def normal(texts: pa.Array) -> pa.Array:
    """Words in lower case, joined by single spaces; null as empty."""
    texts = pc.ascii_trim_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    return pc.binary_join(pc.ascii_split_whitespace(texts), " ")


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(all words of normal texts in order, how many each text has)."""
    lists = pc.split_pattern(texts, " ")
    counts = np.where(pc.binary_length(texts).to_numpy(False) > 0, pc.list_value_length(lists).to_numpy(False), 0)
    words = lists.flatten()
    return words.filter(pc.greater(pc.binary_length(words), 0)), counts


def whole(column) -> pa.Array:
    """A column as one array."""
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) and column.num_chunks != 1 else column.chunk(0) if isinstance(column, pa.ChunkedArray) else column


def packed(values: np.ndarray, ordered: bool = False) -> bytes:
    """An array as bytes: of an ordered one the steps; bytes of equal weight side by side, compressed."""
    if ordered:
        values = np.diff(values, prepend=values.dtype.type(0))
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.itemsize).T.tobytes())


def unpacked(data: bytes, dtype, ordered: bool = False) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    values = np.ascontiguousarray(np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(size, -1).T).view(dtype).reshape(-1)
    return np.cumsum(values, dtype=dtype) if ordered else values


def packed_words(words: pa.Array) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(b" ".join(pc.cast(words, pa.binary()).to_pylist()))


def unpacked_words(data: bytes) -> pa.Array:
    text = zstandard.ZstdDecompressor().decompress(data).decode()
    return pa.array(text.split(" ") if text else [], pa.string())


_WEIGHTS = np.random.default_rng(2).integers(0, 1 << 63, 1 << 12, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def word_parts(words: pa.Array, parts: int) -> Iterator[tuple[int, np.ndarray]]:
    """(part, places of its words) by a hash of each word."""
    lengths = pc.binary_length(words).to_numpy(False).astype(np.int64)
    if not len(lengths):
        return
    data = np.frombuffer(b"".join(pc.cast(words, pa.binary()).to_pylist()), np.uint8)
    starts = np.cumsum(lengths) - lengths
    place = np.arange(len(data)) - np.repeat(starts, lengths)
    hashes = np.add.reduceat((data.astype(np.uint64) + np.uint64(1)) * _WEIGHTS[place & (len(_WEIGHTS) - 1)], starts)
    part = ((hashes >> np.uint64(20)) % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    first = np.flatnonzero(changes(part[order]))
    for a, b in zip(first, np.append(first[1:], len(order))):
        yield int(part[order[a]]), order[a:b]


def joined(symbols: np.ndarray, width: int) -> np.ndarray:
    """At each place the last `width` symbols as one number, the newest in the highest bits; built from halves, in types no
    wider than they need. The first width - 1 places are not meant to be used."""
    if width == 1:
        return symbols
    half = width // 2
    bits = BITS * width
    out = joined(symbols, half).astype(np.uint16 if bits <= 16 else np.uint32 if bits <= 32 else np.int64)
    rest = joined(symbols, width - half)
    out <<= BITS * (width - half)
    out[half:] |= rest[:-half] if half else rest
    return out


def coded(texts: list[bytes], depth: int = DEPTH, most: int = TEXTS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(codes, text of each): for every symbol of every text and its end mark, the symbol in the highest bits and the `depth`
    symbols before it below, the nearest first, end marks before the text's start. So a code without its lowest bits is
    that of a shorter context, and codes in order stay in order. About PART symbols at a time, however long a text is, and at most `most` texts."""
    pad = bytes(depth)
    held: list[bytes] = []
    owners: list[int] = []
    size = 0

    def settle():
        symbols = np.frombuffer(b"".join(held), np.uint8)
        codes = joined(symbols, depth + 1).astype(np.int64)
        lengths = np.array([len(x) for x in held])
        starts = np.cumsum(lengths) - lengths
        real = np.ones(len(symbols), bool)
        for k in range(depth):
            real[starts + k] = False
        return codes[real], np.repeat(np.array(owners, np.int32), lengths - depth)

    for k, text in enumerate(texts):
        symbols = pad + text.translate(SYMBOL) + b"\0"
        for at in range(0, len(symbols) - depth, PART):
            piece = symbols[at : at + PART + depth]
            held.append(piece)
            owners.append(k)
            size += len(piece)
            if size >= PART or len(held) == most:
                yield settle()
                held, owners, size = [], [], 0
    if held:
        yield settle()


def _summed(codes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes and their counts' sums. Where both fit a word they are sorted as one, which is much faster than an
    argument sort; the few whose counts are too large for that are summed apart. The lists are emptied, to need less memory
    at once."""
    code, count = np.concatenate(codes), np.concatenate(counts)
    codes.clear()
    counts.clear()
    room = 63 - int(code.max(initial=0)).bit_length()
    most = (1 << room) - 1
    large = count > most
    code_l, count_l = code[large], count[large]
    code, count = code[~large], count[~large]
    code <<= room
    code |= count
    code.sort()
    np.bitwise_and(code, most, out=count)
    code >>= room
    first = np.flatnonzero(changes(code))
    code, count = code[first], np.add.reduceat(count, first) if len(first) else count
    if len(code_l):
        order = np.argsort(code_l)
        first = np.flatnonzero(changes(code_l[order]))
        code_l, count_l = code_l[order][first], np.add.reduceat(count_l[order], first)
        place = np.searchsorted(code, code_l)
        same = np.append(code, -1)[place] == code_l
        count[place[same]] += count_l[same]
        code, count = np.insert(code, place[~same], code_l[~same]), np.insert(count, place[~same], count_l[~same])
    return code, count


def changes(ordered: np.ndarray) -> np.ndarray:
    """Where a new value begins."""
    return np.append(True, ordered[1:] != ordered[:-1]) if len(ordered) else np.empty(0, bool)


def by_part(codes: np.ndarray, parts: int, depth: int) -> Iterator[tuple[int, np.ndarray]]:
    """(part, places of its codes, in order) by the codes' KEYED nearest context symbols."""
    keyed = min(KEYED, depth)
    key = (codes >> BITS * (depth - keyed)) & ((1 << BITS * keyed) - 1)
    part = ((((key * 0x9E3779B1) & 0xFFFFFFFF) >> 8) % parts).astype(np.uint16 if parts <= 1 << 16 else np.int64)
    order = np.argsort(part, kind="stable")
    first = np.flatnonzero(changes(part[order]))
    for a, b in zip(first, np.append(first[1:], len(order))):
        yield int(part[order[a]]), order[a:b]


COUNTS = "part int, codes binary, counts binary, words binary, word_counts binary, n_words long, n_types long"


def _row(part: int, codes=None, counts=None, words=None, word_counts=None) -> dict:
    return {
        "part": part, "codes": None if codes is None else packed(codes, True), "counts": None if codes is None else packed(counts),
        "words": None if words is None else packed_words(words), "word_counts": None if words is None else packed(word_counts),
        "n_words": 0 if words is None else int(word_counts.sum()), "n_types": 0 if words is None else len(words),
    }


_COUNTS = pa.schema([("part", pa.int32()), *((c, pa.binary()) for c in ("codes", "counts", "words", "word_counts")), ("n_words", pa.int64()), ("n_types", pa.int64())])


def _summed_words(held: list[pa.Table]) -> pa.Table:
    return pa.concat_tables(held).group_by("w").aggregate([("n", "sum")]).rename_columns(["w", "n"])


def counted(texts: DataFrame, parts: int, depth: int = DEPTH) -> DataFrame:
    """Rows of COUNTS over all normal texts that count: different codes in order and their counts, words and their counts. Each
    task sums up its own first, then each part those of all tasks."""

    def stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch["texts"].to_pylist():
                for rows in pa.ipc.open_stream(blob):
                    rows = rows.filter(pc.invert(rows["held_out"]))
                    yield from (rows.slice(at, ROWS_AT_ONCE) for at in range(0, len(rows), ROWS_AT_ONCE))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, counts, size = [], [], 0
        held: list[pa.Table] = []
        n_held = 0

        def out(code, n):
            return pa.RecordBatch.from_pylist([_row(part, code[at], n[at]) for part, at in by_part(code, parts, depth)], _COUNTS)

        def out_words():
            words = _summed_words(held)
            w, n = whole(words["w"]), words["n"].to_numpy()
            held.clear()
            return pa.RecordBatch.from_pylist([_row(part, words=w.take(at), word_counts=n[at]) for part, at in word_parts(w, parts)], _COUNTS)

        for batch in stretches(batches):
            found = words_of(batch["text"])[0].value_counts()
            held.append(pa.table({"w": found.field("values"), "n": found.field("counts")}))
            n_held += len(found)
            if n_held > WORDS_HELD:
                held = [_summed_words(held)]
                n_held = len(held[0])
                if n_held > WORDS_HELD // 2:
                    yield out_words()
                    n_held = 0
            for found, _ in coded(pc.cast(batch["text"], pa.binary()).to_pylist(), depth, ROWS_AT_ONCE):
                found.sort()
                first = np.flatnonzero(changes(found))
                codes.append(found[first])
                counts.append(np.diff(np.append(first, len(found))))
                size += len(first)
                if size > HELD:
                    code, n = _summed(codes, counts)
                    codes, counts, size = [code], [n], len(code)
                    if size > HELD * 3 // 4:
                        yield out(code, n)
                        codes, counts, size = [], [], 0
        if codes:
            yield out(*_summed(codes, counts))
        if held:
            yield out_words()
        give_back_memory()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, codes, counts, size, least = None, [], [], 0, 2 * HELD
        held: list[pa.Table] = []
        n_held, least_words = 0, 2 * WORDS_HELD

        def settle():
            rows = []
            if codes:
                code, n = _summed(codes, counts)
                rows += [_row(part, code[at : at + CODES_A_ROW], n[at : at + CODES_A_ROW]) for at in range(0, len(code), CODES_A_ROW)]
            if held:
                words = _summed_words(held)
                w, n = whole(words["w"]), words["n"].to_numpy()
                rows += [_row(part, words=w.slice(at, CODES_A_ROW), word_counts=n[at : at + CODES_A_ROW]) for at in range(0, len(w), CODES_A_ROW)]
            return pa.RecordBatch.from_pylist(rows, _COUNTS)

        for batch in batches:
            for row in batch.to_pylist():
                if row["part"] != part:
                    if part is not None:
                        yield settle()
                    part, codes, counts, size, least, held, n_held, least_words = row["part"], [], [], 0, 2 * HELD, [], 0, 2 * WORDS_HELD
                if row["codes"] is not None:
                    codes.append(unpacked(row["codes"], np.int64, True))
                    counts.append(unpacked(row["counts"], np.int64))
                    size += len(codes[-1])
                    if size > least:
                        code, total = _summed(codes, counts)
                        codes, counts, size = [code], [total], len(code)
                        least = 2 * max(size, HELD)
                else:
                    held.append(pa.table({"w": unpacked_words(row["words"]), "n": unpacked(row["word_counts"], np.int64)}))
                    n_held += len(held[-1])
                    if n_held > least_words:
                        held = [_summed_words(held)]
                        n_held = len(held[0])
                        least_words = 2 * max(n_held, WORDS_HELD)
        if part is not None:
            yield settle()
        give_back_memory()

    return texts.select("texts").mapInArrow(count, COUNTS).repartition(parts, "part").sortWithinPartitions("part").mapInArrow(merge, COUNTS)


class Tree:
    """levels[d - 1]: sorted contexts of length d that are states, their counts and kinds of next symbols; sorted codes of
    symbols with these contexts, and their counts. root: probabilities."""

    def __init__(self, root: np.ndarray):
        self.root = root
        self.levels: list[tuple[np.ndarray, ...]] = []

    def probability(self, codes: np.ndarray, depth: int) -> np.ndarray:
        """Of each code's symbol after the longest suffix that is a state. codes: in order, of `depth` context symbols. What
        codes share is looked up once: from one length of context to the next, only different ones are refined."""
        known = codes >> BITS * depth
        new = changes(known)
        place, p = np.cumsum(new) - 1, self.root[known[new]]
        for d, (contexts, totals, kinds, grams, counts) in enumerate(self.levels[:depth], 1):
            if not len(contexts):
                continue
            gram = codes >> BITS * (depth - d)
            new = changes(gram)
            gram, p = gram[new], p[place[new]]
            place = np.cumsum(new) - 1
            context = gram & ((1 << BITS * d) - 1)
            at = np.searchsorted(contexts, context)
            at[at == len(contexts)] = 0
            hit = np.flatnonzero(contexts[at] == context)
            at, gram = at[hit], gram[hit]
            n_at = np.searchsorted(grams, gram)
            n_at[n_at == len(grams)] = 0
            n = np.where(grams[n_at] == gram, counts[n_at], 0)
            p[hit] = (n + kinds[at] * p[hit]) / (totals[at] + kinds[at])
        return p[place]


def grow(tree: Tree, codes: np.ndarray, counts: np.ndarray, depth: int, least: float, divergence: float) -> Tree:
    """The tree with the levels it lacks, up to depth. codes: different ones in order, of `depth` context symbols."""
    grown = Tree(tree.root)
    grown.levels = list(tree.levels)
    for d in range(len(grown.levels) + 1, depth + 1):
        gram = codes >> BITS * (depth - d)
        first = np.flatnonzero(changes(gram))
        gram, n = gram[first], np.add.reduceat(counts, first) if len(first) else counts
        before = grown.probability(gram, d)
        context = gram & ((1 << BITS * d) - 1)
        order = np.argsort(context, kind="stable")
        context, gram, n, before = context[order], gram[order], n[order], before[order]
        first = np.flatnonzero(changes(context))
        totals, kinds = np.add.reduceat(n, first) if len(first) else n, np.diff(np.append(first, len(gram)))
        gain = np.add.reduceat(n * np.log(n / np.repeat(totals, kinds) / before), first) if len(first) else before
        kept = (totals >= least) & (gain >= divergence)
        some = np.repeat(kept, kinds)
        own, own_counts = gram[some], n[some]
        order = np.argsort(own)
        grown.levels.append((context[first][kept], totals[kept], kinds[kept], own[order], own_counts[order]))
    return grown


def head(counts: DataFrame, depth: int, least_share: float, divergence: float) -> tuple[Tree, float]:
    """The tree up to NEAR context symbols, and the least count of a state. What comes to the driver are different runs of
    NEAR + 1 symbols: the alphabet bounds them."""
    near = min(NEAR, depth)

    def shorten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c, n in zip(batch["codes"].to_pylist(), batch["counts"].to_pylist()):
                gram = unpacked(c, np.int64, True) >> BITS * (depth - near)
                first = np.flatnonzero(changes(gram))
                yield pa.RecordBatch.from_arrays([pa.array(gram[first]), pa.array(np.add.reduceat(unpacked(n, np.int64), first))], ["gram", "n"])

    got = counts.where("codes is not null").select("codes", "counts").mapInArrow(shorten, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
    gram, n = got.column("gram").to_numpy(), got.column("n").to_numpy()
    order = np.argsort(gram)
    gram, n = gram[order], n[order]
    root = np.full(1 << BITS, SMOOTHING)
    root[SMOOTHED:] /= len(root) - SMOOTHED
    np.add.at(root, gram >> BITS * near, n)
    least = max(LEAST_COUNT, least_share * int(n.sum()))
    return grow(Tree(root / root.sum()), gram, n, near, least, divergence), least


ANSWERS = "chunk int, codes binary, logs binary, words binary, word_counts binary"
_ANSWERS = pa.schema([("chunk", pa.int32()), *((c, pa.binary()) for c in ("codes", "logs", "words", "word_counts"))])


def answered(asked: DataFrame, counts: DataFrame, parts: int, near: Broadcast, depth: int, least: float, divergence: float) -> DataFrame:
    """asked (part, chunk, codes, words) -> rows of ANSWERS: codes with log10 probabilities, words with counts. A task grows a
    part of the tree and then reads what chunks ask it for."""

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, tree, known, own, codes, counts, words = None, None, None, None, [], [], []
        for batch in batches:
            for row in batch.to_pylist():
                if row["part"] != part:
                    part, tree, known, own, codes, counts, words = row["part"], None, None, None, [], [], []
                if row["chunk"] < 0:
                    if row["codes"] is not None:
                        codes.append(unpacked(row["codes"], np.int64, True))
                        counts.append(unpacked(row["counts"], np.int64))
                    else:
                        words.append((unpacked_words(row["words"]), unpacked(row["word_counts"], np.int64)))
                    continue
                out = {"chunk": row["chunk"]}
                if row["codes"] is not None:
                    if tree is None:
                        tree = near.value
                        if codes:
                            code, total = np.concatenate(codes), np.concatenate(counts)
                            order = np.argsort(code)
                            tree = grow(tree, code[order], total[order], depth, least, divergence)
                            codes, counts = [], []
                    logs = np.log10(tree.probability(unpacked(row["codes"], np.int64, True), depth)).astype(np.float32)
                    out |= {"codes": row["codes"], "logs": packed(logs)}
                if row["words"] is not None:
                    if known is None:
                        known = pa.concat_arrays([w for w, _ in words]) if words else pa.array([], pa.string())
                        own = np.append(np.concatenate([n for _, n in words]) if words else np.empty(0, np.int64), 0)
                        words = []
                    at = pc.index_in(unpacked_words(row["words"]), value_set=known).fill_null(len(known)).to_numpy(False)
                    out |= {"words": row["words"], "word_counts": packed(own[at])}
                yield pa.RecordBatch.from_pylist([out], _ANSWERS)
        give_back_memory()

    both = counts.select("part", F.lit(-1).alias("chunk"), "codes", "words", "counts", "word_counts").unionByName(asked, allowMissingColumns=True)
    return both.repartition(parts, "part").sortWithinPartitions("part", "chunk").mapInArrow(answer, ANSWERS)


def different(texts: list[bytes], depth: int) -> np.ndarray:
    """The texts' different codes, in order."""
    found = []
    for codes, _ in coded(texts, depth, ROWS_AT_ONCE):
        codes.sort()
        found.append(codes[changes(codes)])
    if not found:
        return np.empty(0, np.int64)
    codes = np.concatenate(found)
    codes.sort()
    return codes[changes(codes)]


def log_scores(known: np.ndarray, logs: np.ndarray, texts: list[bytes], depth: int) -> np.ndarray:
    """log10 probability of each text, by those of its codes. Codes and the texts they are of are sorted as one word, so that
    each different code is looked up once, in order, and nothing has to be put back in place."""
    total = np.zeros(len(texts))
    for codes, owner in coded(texts, depth):
        base = int(owner.min()) if len(owner) else 0
        bits = int(owner.max() - base).bit_length() if len(owner) else 0
        if BITS * (depth + 1) + bits > 63:
            raise ValueError("a code and the number of its text must fit a word")
        codes <<= bits
        codes |= owner - base
        codes.sort()
        owner = (codes & ((1 << bits) - 1)).astype(np.int32) + base
        codes >>= bits
        first = np.flatnonzero(changes(codes))
        value = logs[np.searchsorted(known, codes[first])]
        total += np.bincount(owner, np.repeat(value, np.diff(np.append(first, len(codes)))), len(texts))
    return total


TEXTS_SCHEMA = "number long, n_training long, n_bytes long, texts binary"


def packed_texts(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def unpacked_texts(blobs) -> pa.Table:
    return pa.concat_tables([pa.ipc.open_stream(x).read_all() for x in blobs.to_pylist()]).combine_chunks()


def normal_rows(docs: DataFrame) -> DataFrame:
    """Stretches of rows, each a compressed table of doc_id (as text), held_out and text in normal form, with a number of its
    own, how many rows count and how many bytes its texts have."""

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, k = TaskContext.get().partitionId(), 0
        held: list[pa.RecordBatch] = []
        size = n = 0

        def settle():
            nonlocal held, size, n, k
            table = pa.Table.from_batches(held)
            training = len(table) - (pc.sum(table["held_out"]).as_py() or 0)
            out = pa.RecordBatch.from_pylist([{"number": (part << 33) + k, "n_training": training, "n_bytes": size, "texts": packed_texts(table)}], _TEXTS)
            held, size, n, k = [], 0, 0, k + 1
            return out

        for batch in (rows.slice(at, STRETCH_ROWS) for rows in batches for at in range(0, len(rows), STRETCH_ROWS)):
            texts = normal(batch["text"])
            held.append(pa.RecordBatch.from_arrays([batch["doc_id"], batch["held_out"], texts], ["doc_id", "held_out", "text"]))
            size += pc.sum(pc.binary_length(texts)).as_py() or 0
            n += len(texts)
            if size >= STRETCH_BYTES or n >= 16 * STRETCH_ROWS:
                yield settle()
        if n:
            yield settle()
        give_back_memory()

    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), in_fold(F.col("doc_id"), FOLD, HELD_OUT).alias("held_out"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(convert, TEXTS_SCHEMA)


_TEXTS = pa.schema([("number", pa.int64()), ("n_training", pa.int64()), ("n_bytes", pa.int64()), ("texts", pa.binary())])


def asking(parts: int, depth: int) -> Callable[[pa.Table], pa.Table]:
    """A chunk's texts -> a row for each part with the chunk's different codes and words of that part."""

    def ask(chunk: pa.Table) -> pa.Table:
        texts = whole(unpacked_texts(chunk["texts"])["text"])
        codes, words = different(pc.cast(texts, pa.binary()).to_pylist(), depth), words_of(texts)[0].unique()
        rows: dict[int, dict] = {part: {"codes": packed(codes[at], True)} for part, at in by_part(codes, parts, depth)}
        for part, at in word_parts(words, parts):
            rows.setdefault(part, {})["words"] = packed_words(words.take(at))
        number = chunk["chunk"][0].as_py()
        out = pa.Table.from_pylist([{"part": part, "chunk": number} | row for part, row in rows.items()], pa.schema([("part", pa.int32()), ("chunk", pa.int32()), ("codes", pa.binary()), ("words", pa.binary())]))
        give_back_memory()
        return out

    return ask


def scored(docs: DataFrame, depth: int = DEPTH, least_share: float = 0.0, divergence: float = DIVERGENCE) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of each document.

    Null text counts as empty: one token, the end. A null doc_id counts as held out; repeated rows are scored and, outside
    the held-out fold, counted each; with no training text counts are zero and symbols equally likely; an empty table
    gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    rows = stored(normal_rows(docs), "normal-texts")
    n_training, n_bytes = (x or 0 for x in rows.agg(F.sum("n_training"), F.sum("n_bytes")).first())
    cores = spark.sparkContext.defaultParallelism
    n_tasks, parts, n_chunks = (max(-(-n_bytes // size), cores) for size in (COUNTED_BYTES, BYTES_A_PART, CHUNK_BYTES))
    counts = stored(counted(rows.coalesce(n_tasks), parts, depth), "counts")
    tree, least = head(counts, depth, least_share, divergence)
    near = spark.sparkContext.broadcast(tree)
    word_tokens, types = counts.agg(F.sum("n_words"), F.sum("n_types")).first()
    n, v = (word_tokens or 0) + n_training, (types or 0) + (n_training > 0)
    # by a stretch's number, so that equal rows spread like any others; both uses below share this one shuffle
    chunked = rows.select(F.pmod(F.xxhash64("number"), F.lit(n_chunks)).cast("int").alias("chunk"), "texts").repartition(n_chunks, "chunk")
    asked = chunked.groupBy("chunk").applyInArrow(asking(parts, depth), "part int, chunk int, codes binary, words binary")
    answers = answered(asked, counts, parts, near, depth, least, divergence)

    def score(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        scale = np.log10(max(n, 1) + 0.1 * (v + 1)) if n else np.log10(0.1 * (v + 1))
        chunk = unpacked_texts(chunk["texts"])
        texts = whole(chunk["text"])
        words, sizes = words_of(texts)
        codes, logs, known, known_counts = [], [], [], []
        for row in answers.to_pylist():
            if row["codes"] is not None:
                codes.append(unpacked(row["codes"], np.int64, True))
                logs.append(unpacked(row["logs"], np.float32))
            if row["words"] is not None:
                known.append(unpacked_words(row["words"]))
                known_counts.append(unpacked(row["word_counts"], np.int64))
        count = np.concatenate(known_counts)[pc.index_in(words, value_set=pa.concat_arrays(known)).to_numpy(False)] if len(words) else np.empty(0, np.int64)
        owner = np.repeat(np.arange(len(texts)), sizes)
        base = np.bincount(owner, np.log10(count + 0.1), len(texts)) + np.log10(n_training + 0.1) - (sizes + 1) * scale
        n_known = np.bincount(owner, count > 0, len(texts)).astype(np.int64) + (n_training > 0)
        codes, logs = np.concatenate(codes), np.concatenate(logs)
        order = np.argsort(codes)
        codes, logs = codes[order], logs[order]
        scores = log_scores(codes, logs, pc.cast(texts, pa.binary()).to_pylist(), depth)
        out = pa.table({"doc_id": whole(chunk["doc_id"]), "held_out": whole(chunk["held_out"]), "n_tokens": sizes.astype(np.int64) + 1, "n_known": n_known, "base_score": base, "score": scores})
        del words, known, codes, logs, order
        give_back_memory()
        return out

    schema = "doc_id string, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    out = chunked.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(score, schema)
    return out.select(F.col("doc_id").cast("long").alias("doc_id"), "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score")
