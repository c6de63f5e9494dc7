"""Arrow batches cut to bounded size before Python objects are made of them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BYTES_AT_ONCE = 4 << 20


def small(batches, column: int, limit: int = BYTES_AT_ONCE):
    """The same rows in order, in slices whose ``column`` (text or lists) holds
    at most ``limit`` bytes or list items, or a single row."""
    for b in batches:
        c = b.column(column)
        size = pc.list_value_length(c) if pa.types.is_list(c.type) or pa.types.is_large_list(c.type) else pc.binary_length(c)
        upto = np.cumsum(pc.fill_null(size, 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < b.num_rows:
            to = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + limit, "right")))
            yield b.slice(at, to - at)
            at = to
