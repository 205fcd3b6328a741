"""Python functions over columns of text, a few texts at a time."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa

#: Texts that are Python strings at once: a batch of whole texts, in several variants, is many times its size as such.
AT_ONCE = 128


def mapped(c: pa.Array, f: Callable[[str], str]) -> pa.Array:
    """f of each text; null stays null."""
    parts = [pa.array([None if s is None else f(s) for s in c.slice(i, AT_ONCE).to_pylist()], pa.string()) for i in range(0, len(c), AT_ONCE)]
    return pa.concat_arrays(parts) if parts else pa.array([], pa.string())
