import hashlib
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from quillmine.llm import media, packing

from .helpers import documents, empty_documents, odd_documents


def test_media_holds_every_byte(spark, sf):
    for docs in (odd_documents(spark), documents(spark, sf)):
        texts = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        got = media.media_columns(docs).collect()
        assert len(got) == len(texts)
        by_id = {}
        for r in got:
            by_id.setdefault(r.doc_id, []).append(r)
        for doc_id, text in texts:
            data = (text or "").encode()
            padded = data + b" " * (-len(data) % 192 or (0 if data else 192))
            assert any(
                media.from_wav(bytes(r.media)) == padded and (r.n_bytes, r.payload_bytes, r.tail_crc32) == (len(data), len(padded), zlib.crc32(padded[-16:]))
                and r.payload_sha256 == hashlib.sha256(padded).hexdigest() and r.media_sha256 == hashlib.sha256(bytes(r.media)).hexdigest() and r.media_bytes == len(r.media)
                for r in by_id[doc_id]
            )


def test_landmarks_by_plain_loops():
    samples = np.frombuffer(media.to_payload("the quick brown fox jumps over the lazy dog " * 40)[0], np.uint8)
    wave = samples.astype(np.float64) - 128
    window, peak = np.hanning(media.FRAME).astype(np.float32), []
    for t in range(len(samples) // media.BLOCK - 1):
        frame = wave[t * media.BLOCK : t * media.BLOCK + media.FRAME]
        power = np.abs(np.fft.rfft((frame - frame.mean()) * window))
        row = []
        for low, high in media.BANDS:
            k = low + int(power[low:high].argmax())
            row.append((k, power[k] >= media.STANDS_OUT * power[low:high].mean()))
        peak.append(row)
    expected = []
    for t in range(len(peak)):
        for b in range(4):
            for gap in (0, 1, 2):
                t2, b2 = t + gap, b + (gap == 0)
                if t2 < len(peak) and b2 < 4 and peak[t][b][1] and peak[t2][b2][1]:
                    expected.append((t, (peak[t][b][0] << 12) | (peak[t2][b2][0] << 3) | gap))
    times, codes = media.landmarks(samples)
    assert expected and list(zip(times.tolist(), codes.tolist())) == expected


def test_short_texts_have_landmarks_of_their_own():
    texts = ["", "a", "one two", "other words", "x" * 100, "some more words here, " * 9, "y" * 384]
    found = [tuple(map(tuple, media.media_row(t)[6:8])) for t in texts]
    assert all(len(times) for times, _ in found) and len(set(found)) >= 5


def test_landmarks_of_long_files_do_not_depend_on_chunks(monkeypatch):
    samples = np.random.default_rng(1).integers(0, 255, media.BLOCK * 300, dtype=np.uint8)
    whole = media.landmarks(samples)
    monkeypatch.setattr(media, "FRAMES_AT_ONCE", 17)
    assert all((a == b).all() for a, b in zip(whole, media.landmarks(samples)))


def test_packing_round_trip(spark, sf):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for docs, length in ((odd_documents(spark), 64), (documents(spark, sf), 1024)):
        rows = docs.select("doc_id", "text").collect()
        pieces = packing.pack(docs, length=length).toPandas()
        ids = {}
        for r in rows:
            ids.setdefault(r.doc_id, []).append([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 0])
        total = sum(len(x) for v in ids.values() for x in v)
        assert pieces["length"].sum() == total and pieces["length"].between(1, length).all()
        for sequence, part in pieces.groupby("sequence_id"):
            part = part.sort_values("offset")
            assert part["offset"].tolist() == [0, *part["length"].cumsum().tolist()[:-1]]
            filled = part["length"].sum()
            assert filled == (length if (sequence + 1) * length <= total else total % length) == part["sequence_tokens"].iloc[0]
            assert part["padded_length"].iloc[0] == (filled if filled & (filled - 1) == 0 else length)
        seen = {}
        for p in pieces.itertuples():
            got = np.frombuffer(p.ids, "<u4").tolist()
            key = None if p.doc_id != p.doc_id else int(p.doc_id)
            whole = [x for x in ids[key] if len(x) == p.doc_tokens and x[p.start : p.start + p.length] == got]
            assert whole and p.ids_crc32 == zlib.crc32(p.ids)
            seen[key] = seen.get(key, 0) + p.length
        assert seen == {k: sum(map(len, v)) for k, v in ids.items()}


def test_fast_and_full_tokenizers_agree():
    tokenizer, encode = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), packing.encoder(packing.VOCABULARY)
    for text in ("", " ", "a  b\n\n c\t", "É è ñ ß  x", "日本語テキスト", "٣٤٥ ½ Ⅷ", "don't we'LL", "é \U0001f600!!", "<|endoftext|>x"):
        assert encode(text) == tokenizer.encode(text, add_special_tokens=False).ids


def test_empty_tables(spark):
    assert packing.pack(empty_documents(spark)).count() == 0
    assert media.media_columns(empty_documents(spark)).count() == 0


def test_very_long_runs_are_packed(spark):
    """Runs that the faster library cannot read, or only slowly: their ids are those of the vocabulary's own tokenizer."""
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["x" + " " * 1_000_000 + "y", "\n" * 300_000, "a \u3000" * 100 + "\u2003" * 50_000 + "b", "x" * 300_000, "7" * 300_000, "!" * 300_000]
    pieces = packing.pack(spark.createDataFrame([*enumerate(texts)], "doc_id long, text string").repartition(3), length=1 << 20).toPandas()
    for k, text in enumerate(texts):
        own = pieces[pieces["doc_id"] == k].sort_values("start")
        got = np.concatenate([np.frombuffer(x, "<u4") for x in own["ids"]]).tolist()
        assert got == tokenizer.encode(text, add_special_tokens=False).ids + [0], k


def test_both_libraries_agree_beside_every_kind_of_sign():
    tokenizer, encode = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), packing.encoder("byte_bpe_50k")
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000 and (c < 0x3400 or c % 37 == 0)]
    texts = ["".join(f"a{chr(c)}b {chr(c)}1{chr(c)} 's{chr(c)}{chr(c)}  {chr(c)}x\n{chr(c)} {chr(c)}" for c in points[at : at + 16]) for at in range(0, len(points), 16)]
    assert [encode(t) for t in texts] == [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
