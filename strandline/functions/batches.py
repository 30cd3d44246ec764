"""Arrow batches a run of rows at a time, so that few of them are Python objects at once."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are Python objects at once, unless one text is longer.
TOGETHER = 1 << 20


def runs(texts: pa.Array, most: int | None = None) -> Iterator[tuple[int, int]]:
    """(first, end) of rows whose texts together stay within ``most`` bytes, or of one row alone; each row counts 64 more."""
    first = size = 0
    for i, n in enumerate(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
        if i > first and size + n + 64 > (most or TOGETHER):
            yield first, i
            first, size = i, 0
        size += n + 64
    if first < len(texts):
        yield first, len(texts)
