"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from gridmix.session import checkpoint_dir

# texts of one Arrow batch are worked on in slices of about this many bytes,
# so that a batch of long texts needs no more memory than one of short texts
SLICE_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def unused(columns: Iterable[str], name: str) -> str:
    """``name``, with as many underscores as none of the columns, in whatever case, is named."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: cuts lineage, survives lost executors."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(batch: pa.RecordBatch, text: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch at about ``most`` bytes of text; a single longer text stays whole."""
    if batch.num_rows == 0:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    cut = np.cumsum(sizes, dtype=np.int64) // most
    starts = np.flatnonzero(np.diff(cut, prepend=-1))
    for begin, end in zip(starts, [*starts[1:], batch.num_rows]):
        yield batch.slice(begin, end - begin)


def words(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of each text (null: none).

    Returns (offsets, codes, vocabulary): text i has the words
    ``vocabulary[codes[offsets[i]:offsets[i + 1]]]``.
    """
    texts = pc.fill_null(texts, "")
    if lower:  # A-Z only
        texts = pc.ascii_lower(texts)
    lists = pc.ascii_split_whitespace(texts)  # exactly the six ASCII white-space bytes
    coded = lists.flatten().dictionary_encode()
    vocabulary, codes = coded.dictionary, coded.indices.to_numpy()
    counts = lists.value_lengths().to_numpy().astype(np.int64)
    empty = pc.index(vocabulary, "").as_py()
    if empty >= 0:  # white space at either end of a text leaves empty strings
        real = codes != empty
        row = np.repeat(np.arange(len(counts)), counts)[real]
        counts = np.bincount(row, minlength=len(counts))
        codes = codes[real]
    return np.concatenate(([0], np.cumsum(counts))), codes, vocabulary


def binary_column(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Binary array whose items are consecutive runs of bytes of ``values``.

    ``ends``: byte offsets, one more than items.
    """
    data = np.ascontiguousarray(values)
    return pa.Array.from_buffers(
        pa.binary(), len(ends) - 1,
        [None, pa.py_buffer(np.ascontiguousarray(ends, dtype=np.int32)), pa.py_buffer(data)])
