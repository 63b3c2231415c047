"""Words of whole texts, cut in Arrow: shared by the operators that match words."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: What stands between words once A-Z is lower-cased: ASCII but 0-9 and a-z.
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def slices(batch: pa.RecordBatch, text_col: str, limit: int):
    """The batch in runs of rows of at most ``limit`` text bytes (one row at least)."""
    column = batch.column(batch.schema.get_field_index(text_col))
    sizes = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        before = sizes[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(sizes, before + limit, side="right")))
        yield batch.slice(at, end - at)
        at = end


def lower_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words in order and, for each, the row it is of. Null has none."""
    cut = pc.split_pattern_regex(pc.ascii_lower(pc.fill_null(texts, "")), BETWEEN_WORDS)
    rows = np.repeat(np.arange(len(cut)), pc.list_value_length(cut).to_numpy(zero_copy_only=False))
    parts = pc.list_flatten(cut)
    real = pc.greater(pc.binary_length(parts), 0)
    return parts.filter(real), rows[real.to_numpy(zero_copy_only=False)]
