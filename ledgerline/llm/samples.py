"""Bounded, repeatable samples of rows with their features, for fitting models."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import ngrams as NG
from ledgerline.llm.words import slices


def first_by_hash(rows: DataFrame, key: str, limit: int) -> DataFrame:
    """The ``limit`` rows whose hashed key is smallest: a sample that doesn't
    depend on how the rows are dealt out."""
    return rows.orderBy(F.xxhash64(F.col(key), F.lit(7)), key).limit(limit)


def collect_packed(rows: DataFrame, label: str, text: str = "text"
                   ) -> tuple[list[bytes | None], np.ndarray]:
    """(packed features, labels) of a bounded set of rows, ordered by their content, on
    the driver: 2 bytes a feature. ``unpacked`` makes 4 of them."""

    def feature_rows(batches):
        for batch in batches:
            for part in slices(batch, text, NG.PIECE):
                values = NG.vectors(part.column(part.schema.get_field_index(text)).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(part.schema.get_field_index(label)).cast(pa.int32()),
                     pa.array([x.astype(np.float16).tobytes() for x in values * 1024], pa.binary())],
                    names=["label", "x"])

    got = rows.select(label, text).mapInArrow(feature_rows, "label int, x binary").toArrow()
    labels, packed = got.column("label").to_pylist(), got.column("x").to_pylist()
    del got
    order = sorted(range(len(packed)), key=lambda i: (labels[i], packed[i]))
    return [packed[i] for i in order], np.array([labels[i] for i in order], dtype=np.int32)


def unpacked(packed: list[bytes | None], order: np.ndarray) -> np.ndarray:
    """The features of the rows named by ``order``, each taken out of ``packed``, so that
    the sample is held once."""
    x = np.empty((len(order), NG.WIDTH), dtype=np.float32)
    for row, i in zip(x, order):
        row[:] = np.frombuffer(packed[i], dtype=np.float16)
        packed[i] = None
    x /= 1024
    return x


def collect_features(rows: DataFrame, label: str, text: str = "text"
                     ) -> tuple[np.ndarray, np.ndarray]:
    """(features, labels) of a bounded set of rows, ordered by their content, on the driver."""
    packed, labels = collect_packed(rows, label, text)
    return unpacked(packed, np.arange(len(packed))), labels
