"""What several operators share: text columns, folds of rows, samples, stored tables."""

from __future__ import annotations

import ctypes

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmine.sources.shared import release, remove, stored, stored_at  # noqa: F401

#: A word: a run without ASCII white space (Java and RE2 agree on this class).
WORD = r"[^\x20\x09-\x0D]+"
#: The same class for Python's bytes; bytes.split() without arguments cuts at exactly these six bytes.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def quoted(name: str) -> str:
    """A column's name as Spark reads it, whatever signs it holds."""
    return "`" + name.replace("`", "``") + "`"


def row_struct(columns: list[str], alias: str = "row") -> Column:
    """All columns as one, so that no name can clash with an operator's own."""
    return F.struct(*[F.col(quoted(c)).alias(c) for c in columns]).alias(alias)


def row_columns(columns: list[str], row: str = "row") -> list[Column]:
    """row_struct() undone."""
    return [F.col(row).getField(c).alias(c) for c in columns]


def lower_ascii(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def crc_of_id(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary"))


def in_fold(doc_id: Column, modulus: int, remainder: int) -> Column:
    """crc32(doc_id as text) mod modulus = remainder; a row without doc_id counts as held out, so nothing learns from it."""
    return F.coalesce(crc_of_id(doc_id) % modulus == remainder, F.lit(True))


def bounded_sample(rows: DataFrame, most: int, salt: str, *key: Column) -> DataFrame:
    """At most `most` rows by a hash of the key, and with some margin that many where there are. Rows beyond a share that the
    table's size gives go before anything is ordered, so no task orders more than a few times `most` rows."""
    n = rows.count()
    luck = F.pmod(F.xxhash64(F.lit(salt), *key), F.lit(1 << 40))
    share = min(1.0, 4 * most / max(n, 1))
    return rows.where(luck < int(share * (1 << 40)) + 1).orderBy(luck, *key).limit(most)


def give_back_memory() -> None:
    """Returns what a Python worker has freed to the system: workers outlive their tasks, and what they keep unused counts
    against the executor while others run."""
    import pyarrow

    pyarrow.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass
