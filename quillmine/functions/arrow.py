"""Values of an Arrow array through a plain function."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa

#: Values that are Python objects at a time; a batch can hold 10,000 rows or 64 MB.
SLICE = 128


def mapped(values: pa.Array, f: Callable, kind: pa.DataType, nulls: bool = False) -> pa.Array:
    """f of each value; nulls stay, or go to f as well. Only a slice's values and results are Python objects at a time, which take several times
    the bytes they have as Arrow."""
    if not len(values) or values.null_count == len(values) and not nulls:
        return pa.nulls(len(values), kind)
    parts = [pa.array([None if x is None and not nulls else f(x) for x in values.slice(k, SLICE).to_pylist()], kind) for k in range(0, len(values), SLICE)]
    return pa.concat_arrays(parts)
