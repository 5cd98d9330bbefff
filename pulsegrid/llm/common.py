"""Helpers shared by the operators: tables, scratch tables, word and hash maps.

Everything here is small and local to a task; Spark moves the data.
"""

from __future__ import annotations

import sys
import types
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.session import scratch_path

SPACES = " \t\n\x0b\x0c\r"   # the characters of [\x20\x09-\x0D]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared checkpoint folder and read it back.

    Cuts the lineage in a form that survives lost executors.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def hash_sample(df: DataFrame, cols: list[str], n: int) -> DataFrame:
    """At most ``n`` rows, chosen by a hash of ``cols``; few more ever meet in one task."""
    total = df.count()
    if total <= n:
        return df
    h = F.pmod(F.xxhash64(*cols), F.lit(1 << 30))
    return df.filter(h < int((1 << 30) * min(1.0, 1.25 * n / total))).orderBy(h, *cols).limit(n)


def crc_text(id_col) -> "F.Column":
    """crc32 of the id written as text (what the folds are cut by)."""
    return F.crc32(F.col(id_col).cast("string").cast("binary"))


def worker_state() -> types.ModuleType:
    """A module object that lives as long as the Python worker (task caches)."""
    return sys.modules.setdefault("pulsegrid_worker_state", types.ModuleType("pulsegrid_worker_state"))


class BoundedMap(dict):
    """A dict that computes missing values and forgets in two generations.

    At most ``2 * limit`` entries are held; what was used since the last turn
    of the generations survives it.
    """

    def __init__(self, compute, limit: int):
        super().__init__()
        self.compute, self.limit, self.old = compute, limit, {}

    def __missing__(self, key):
        old = self.old
        value = old[key] if key in old else self.compute(key)
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


def word_hashes() -> BoundedMap:
    """word bytes -> 64-bit hash, cached for the life of the Python worker."""
    state = worker_state()
    if not hasattr(state, "word_hashes"):
        import xxhash
        state.word_hashes = BoundedMap(xxhash.xxh64_intdigest, 250_000)
    return state.word_hashes


def text_bytes(column: pa.Array) -> list:
    """The values of a string column as bytes (None for null)."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


def lower_words(raw: bytes) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z (bytes methods touch ASCII alone)."""
    return raw.lower().split()


def shingle_set(raw: bytes | None, width: int, hashes: BoundedMap) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``width``-word shingles of a text.

    Fewer words than ``width``: the whole sequence is one shingle.  No words: empty.
    """
    words = lower_words(raw) if raw else []
    n = len(words)
    if n == 0:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, n)
    k = min(width, n)
    out = np.full(n - k + 1, 0x9E3779B97F4A7C15 + k, np.uint64)
    for i in range(k):
        out = (out ^ h[i:n - k + 1 + i]) * np.uint64(0xFF51AFD7ED558CCD)
        out ^= out >> np.uint64(32)
    return np.unique(out)


def batch(arrays: dict, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(arrays[f.name], f.type) if not isinstance(arrays[f.name], pa.Array)
                                       else arrays[f.name] for f in schema], schema=schema)
