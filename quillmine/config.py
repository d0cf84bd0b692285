"""Settings and their checks, before anything runs."""

from __future__ import annotations

import hashlib
import json
import math
import re
from dataclasses import asdict, dataclass

COMPRESSIONS = ("zstd", "gzip", "snappy")


def _need(ok: bool, what: str) -> None:
    if not ok:
        raise ValueError(what)


def normal_prefix(prefix: str) -> str:
    """Without slashes at the ends; empty or with one at its end."""
    bare = prefix.strip().strip("/")
    return f"{bare}/" if bare else ""


@dataclass(frozen=True)
class PreparationSettings:
    """Corpus preparation."""

    # The defaults.
    validation_fraction: float = 0.01
    other_fraction: float = 0.10
    least_characters: int = 200
    least_script_ratio: float = 0.20
    script: str = "Cyrillic"
    shard_rows: int = 1000
    seed: int = 42
    limit: int | None = None
    compression: str = "zstd"

    def validate(self) -> PreparationSettings:
        _need(0 <= self.validation_fraction <= 1, "validation_fraction must be from 0 to 1")
        _need(0 <= self.other_fraction < 1, "other_fraction must be at least 0 and below 1")
        _need(self.least_characters >= 0, "least_characters must not be negative")
        _need(0 <= self.least_script_ratio <= 1, "least_script_ratio must be from 0 to 1")
        _need(self.shard_rows > 0, "shard_rows must be positive")
        _need(self.limit is None or self.limit > 0, "limit must be positive")
        _need(self.compression in COMPRESSIONS, f"compression must be one of {COMPRESSIONS}")
        return self


@dataclass(frozen=True)
class ExtractionSettings:
    """F8: batches and calls of the extraction."""

    # The defaults.
    batch_tokens: int = 6000
    overlap_tokens: int = 256
    context_tokens: int = 131_072
    most_new_tokens: int = 8192
    retries: int = 1
    table: str = "documents"

    def validate(self) -> ExtractionSettings:
        _need(self.batch_tokens > 0, "batch_tokens must be positive")
        _need(0 <= self.overlap_tokens < self.batch_tokens, "overlap_tokens must be at least 0 and below batch_tokens")
        _need(0 < self.most_new_tokens < self.context_tokens, "most_new_tokens must be positive and below context_tokens")
        _need(self.retries >= 0, "retries must not be negative")
        _need(re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*(\.[A-Za-z_][A-Za-z0-9_]*){0,2}", self.table) is not None, "table must be a name")
        return self


def identity(settings, **more) -> str:
    """K9: a hash that is equal for equal settings, whatever the order of their fields."""
    value = {"settings": asdict(settings), **more}
    return hashlib.sha256(json.dumps(value, ensure_ascii=False, sort_keys=True).encode()).hexdigest()


def accumulation_steps(batch: int, wanted: int = 64) -> int:
    """Batches whose gradients are added up so that at least `wanted` sequences count."""
    _need(batch > 0, "batch must be positive")
    return max(1, math.ceil(wanted / batch))


#: Least memory of a device in GiB, and the sequences a batch that it takes.
BATCH_BY_MEMORY = ((70, 64), (35, 32), (20, 16), (0, 8))
WITHOUT_DEVICE = 4


def batch_for_memory(gib: float | None) -> int:
    """Sequences a batch for a device of so much memory; None: no device."""
    return WITHOUT_DEVICE if gib is None else next(batch for least, batch in BATCH_BY_MEMORY if gib >= least)
