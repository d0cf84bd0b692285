"""Media columns: texts kept losslessly as 8-bit mono WAV files, and landmark fingerprints of their sound.

A payload is the text's UTF-8 bytes and spaces up to a positive multiple of 192; each byte is one sample. The stored file
is read back with the wave module, cut into overlapping frames, transformed (short-time Fourier), and the strongest bin
of each band of a frame that stands out is a peak. Each peak is paired with those of its band in the next frames and with
that of the next band; a pair is a landmark, held as two parallel arrays: the frame of its first peak, and a code of both
bins and the frames between.
"""

from __future__ import annotations

import hashlib
import io
import wave
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmine.llm.common import give_back_memory

BLOCK = 192
RATE = 8000
FRAME = 2 * BLOCK
BANDS = ((2, 12), (12, 32), (32, 72), (72, 192))
REACH = 2
#: A peak is at least so many times its band's mean magnitude.
STANDS_OUT = 2.0
FRAMES_AT_ONCE = 4096
SCHEMA = "doc_id string, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, times array<int>, codes array<int>, media binary"


def to_payload(text: str | None) -> tuple[bytes, int]:
    data = (text or "").encode("utf-8", "surrogatepass")
    return data + b" " * ((-len(data)) % BLOCK if data else BLOCK), len(data)


def to_wav(payload: bytes) -> bytes:
    out = io.BytesIO()
    with wave.open(out, "wb") as file:
        file.setnchannels(1)
        file.setsampwidth(1)
        file.setframerate(RATE)
        file.writeframes(payload)
    return out.getvalue()


def from_wav(media: bytes) -> bytes:
    with wave.open(io.BytesIO(media), "rb") as file:
        return file.readframes(file.getnframes())


_WINDOW = np.hanning(FRAME).astype(np.float32)


def peaks(samples: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per frame and band the strongest bin, and whether it stands out. Frames overlap by half and are taken some thousand
    at a time, so a very long file needs little memory."""
    n = len(samples) // BLOCK
    blocks = samples[: n * BLOCK].reshape(n, BLOCK)
    if n == 1:  # in the middle of a frame of spaces, where the window is open
        blocks, n = np.pad(blocks.reshape(-1), BLOCK // 2, constant_values=32).reshape(2, BLOCK), 2
    best, strong = np.empty((n - 1, len(BANDS)), np.int32), np.empty((n - 1, len(BANDS)), bool)
    for at in range(0, n - 1, FRAMES_AT_ONCE):
        part = blocks[at : at + FRAMES_AT_ONCE + 1].astype(np.float32)
        frames = np.concatenate([part[:-1], part[1:]], axis=1)
        frames -= frames.mean(axis=1, keepdims=True)
        frames *= _WINDOW
        power = np.abs(np.fft.rfft(frames, axis=1))
        for k, (low, high) in enumerate(BANDS):
            band = power[:, low:high]
            top = band.argmax(axis=1)
            best[at : at + len(part) - 1, k] = top + low
            strong[at : at + len(part) - 1, k] = np.take_along_axis(band, top[:, None], 1)[:, 0] >= STANDS_OUT * band.mean(axis=1)
    return best, strong


def landmarks(samples: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(frame, code) of each pair of peaks, by frame, band and distance: of one band 1 to REACH frames apart, or of a band and
    the next one in the same frame (distance 0). A file without any pair, such as a short one without strong peaks, has the
    strongest bins of its first frame in place of peaks, so every file has landmarks."""
    best, strong = peaks(samples)
    times, codes, order = [], [], []

    def pairs(t, band, other, gap):
        times.append(t)
        codes.append((best[t, band] << 12) | (other << 3) | gap)
        order.append((t * len(BANDS) + band) * (REACH + 1) + gap)

    t, band = np.nonzero(strong[:, :-1] & strong[:, 1:])
    pairs(t, band, best[t, band + 1], 0)
    for gap in range(1, REACH + 1):
        if len(best) > gap:
            t, band = np.nonzero(strong[:-gap] & strong[gap:])
            pairs(t, band, best[t + gap, band], gap)
    if not any(map(len, times)):
        band = np.arange(len(BANDS) - 1)
        pairs(np.zeros_like(band), band, best[0, 1:], 0)
    by = np.argsort(np.concatenate(order), kind="stable")
    return np.concatenate(times)[by].astype(np.int32), np.concatenate(codes)[by].astype(np.int32)


def media_row(text: str | None, with_media: bool = True) -> tuple:
    payload, n_bytes = to_payload(text)
    media = to_wav(payload)
    back = from_wav(media)
    times, codes = landmarks(np.frombuffer(back, np.uint8))
    return (n_bytes, len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-16:]), len(media), hashlib.sha256(media).hexdigest(), times, codes, media if with_media else None)


def media_columns(docs: DataFrame, with_media: bool = True) -> DataFrame:
    """Each document's text as a WAV file (`media`, null if with_media is false), digests of the samples read back from it,
    and its landmarks (`times`, `codes`).

    Null text counts as empty: its payload is 192 spaces. A null doc_id is kept, repeated rows give equal rows, an empty
    table gives no rows, other columns are ignored. A text within two blocks has one frame; it has landmarks as any other.
    """

    def convert(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "times", "codes", "media"]
        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.iloc[at : at + 500]
                out = pd.DataFrame([media_row(text, with_media) for text in part["text"]], columns=names)
                out.insert(0, "doc_id", part["doc_id"].to_numpy())
                yield out
        give_back_memory()

    # doc_id crosses Python as text: beside nulls pandas would hold it as a float
    rows = docs.select(F.col("doc_id").cast("long").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInPandas(convert, SCHEMA).withColumn("doc_id", F.col("doc_id").cast("long"))


def landmark_text(times, codes):
    """The landmarks as one string, `frame:code` in hexadecimal, comma-joined."""
    return F.array_join(F.transform(F.arrays_zip(times.alias("t"), codes.alias("c")), lambda x: F.concat_ws(":", F.lower(F.hex(x["t"])), F.lower(F.hex(x["c"])))), ",")
