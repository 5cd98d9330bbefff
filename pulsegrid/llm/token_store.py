"""Token-id store: each document compressed by itself with one shared zstandard dictionary.

File format: a folder with two Parquet tables.
``dictionary``  one row: ``dict_hash`` (sha256 hex) and ``dictionary`` (bytes; empty: none).
``blocks``      rows of up to ``BLOCK_BYTES`` of frames, in ascending id order:
    part, block      place in the order of the store
    first_id, last_id  smallest and largest doc_id of the block (statistics prune look-ups)
    doc_ids          int64 little-endian, one per document (``null_ids`` leading rows have a null id)
    offsets          int64 little-endian, n + 1 byte offsets of the frames in ``frames``
    starts           int64 little-endian, n + 1 ids before each document within the part
    frames           one zstandard frame per document: its ids as little-endian uint32
    dict_hash        the dictionary the frames need
Spark's writer commits whole tasks, so a lost executor leaves no half-written file.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pulsegrid.llm.common import hash_sample, text_bytes
from pulsegrid.llm.tokens import DEFAULT_VOCABULARY, encoder
from pulsegrid.session import scratch_path

END_ID = 2
BLOCK_BYTES = 1 << 20
DICTIONARY_BYTES = 64 << 10
SAMPLE_DOCS = 2000        # documents the dictionary is trained on, at most ...
SAMPLE_CHARS = 4096       # ... each of at most this length: the dictionary serves short documents
LEVEL = 3

_BLOCK = ("part int, block int, first_id long, last_id long, n_docs int, null_ids int, n_ids long, "
          "doc_ids binary, offsets binary, starts binary, frames binary, dict_hash string")
_BLOCK_ARROW = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("first_id", pa.int64()),
                          ("last_id", pa.int64()), ("n_docs", pa.int32()), ("null_ids", pa.int32()),
                          ("n_ids", pa.int64()), ("doc_ids", pa.binary()), ("offsets", pa.binary()),
                          ("starts", pa.binary()), ("frames", pa.binary()), ("dict_hash", pa.string())])


def _zdict(raw: bytes):
    import zstandard
    return zstandard.ZstdCompressionDict(raw) if raw else None


def train_dictionary(docs: DataFrame, vocabulary: str = DEFAULT_VOCABULARY, id_col: str = "doc_id",
                     text_col: str = "text") -> bytes:
    """Dictionary of serialised id arrays of a bounded sample (chosen by hash).

    Too few or too uniform samples give no dictionary (empty bytes).
    """
    import zstandard
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    sample = (hash_sample(rows, ["id", "text"], SAMPLE_DOCS).select("text")
              .filter(F.length("text").between(1, SAMPLE_CHARS)))

    def run(batches):
        enc = encoder(vocabulary)
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([enc.encode(t) for t in text_bytes(b.column(0))],
                                                       pa.binary())], names=["ids"])
    samples = [bytes(r[0]) for r in sample.mapInArrow(run, "ids binary").collect()]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes() if len(samples) >= 8 else b""
    except zstandard.ZstdError:
        return b""


def write_store(docs: DataFrame, path: str, vocabulary: str = DEFAULT_VOCABULARY, id_col: str = "doc_id",
                text_col: str = "text", end_id: int = END_ID) -> None:
    """Encode every whole text, append ``end_id``, write the store in ascending (id, text) order.

    Null text is empty (the end id alone); a null id sorts first; repeated
    rows are stored as often as they come; an empty table gives an empty
    store; other columns are not read.
    """
    spark = docs.sparkSession
    raw = train_dictionary(docs, vocabulary, id_col, text_col)
    digest = hashlib.sha256(raw).hexdigest()
    spark.createDataFrame([(digest, bytearray(raw))], "dict_hash string, dictionary binary") \
        .coalesce(1).write.parquet(f"{path}/dictionary")
    end = int(end_id).to_bytes(4, "little")

    def run(batches):
        import zstandard
        enc = encoder(vocabulary)
        made = zstandard.ZstdCompressor(level=LEVEL, dict_data=_zdict(raw), write_content_size=True)
        part, block, before = TaskContext.get().partitionId(), 0, 0
        ids, frames, sizes, counts = [], [], 0, []

        def flush():
            nonlocal block, before, ids, frames, sizes, counts
            known = [i for i in ids if i is not None]
            starts = before + np.concatenate([[0], np.cumsum(counts)]).astype("<i8")
            offsets = np.concatenate([[0], np.cumsum([len(f) for f in frames])]).astype("<i8")
            row = [part, block, min(known, default=None), max(known, default=None), len(ids), len(ids) - len(known),
                   int(sum(counts)), np.array([i or 0 for i in ids], "<i8").tobytes(), offsets.tobytes(),
                   starts.tobytes(), b"".join(frames), digest]
            block, before = block + 1, int(starts[-1])
            ids, frames, sizes, counts = [], [], 0, []
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, _BLOCK_ARROW)],
                                              schema=_BLOCK_ARROW)
        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), text_bytes(b.column(1))):
                data = enc.encode(text) + end
                frame = made.compress(data)
                ids.append(doc_id)
                frames.append(frame)
                counts.append(len(data) // 4)
                sizes += len(frame)
                if sizes >= BLOCK_BYTES:
                    yield flush()
        if ids:
            yield flush()

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    # rows of one id, or without one, are dealt by how their texts begin, which keeps the order (id, text)
    (rows.withColumn("_h", F.substring("text", 1, 32)).repartitionByRange("id", "_h").sortWithinPartitions("id", "text")
         .select("id", "text").mapInArrow(run, _BLOCK).write.parquet(f"{path}/blocks"))


def _dictionaries(spark: SparkSession, path: str) -> dict[str, bytes]:
    """hash -> dictionary; one row of at most ``DICTIONARY_BYTES``."""
    known = {r[0]: bytes(r[1]) for r in spark.read.parquet(f"{path}/dictionary").collect()}
    for digest, raw in known.items():
        if hashlib.sha256(raw).hexdigest() != digest:
            raise ValueError("the dictionary does not match its hash")
    return known


def read_store(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """Every document of a store: ``doc_id, start, n_tokens, ids_crc32`` (and ``ids`` if asked)."""
    known = _dictionaries(spark, path)
    blocks = spark.read.schema(_BLOCK).parquet(f"{path}/blocks")
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))      # a row per written partition
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select(F.col("part").alias("p"), before.alias("before"))
    schema = "part int, doc_id long, at long, n_tokens long, ids_crc32 long" + (", ids binary" if with_ids else "")
    cols = ["part", "n_docs", "null_ids", "doc_ids", "offsets", "starts", "frames", "dict_hash"]

    def run(batches):
        import zstandard
        open_ = {h: zstandard.ZstdDecompressor(dict_data=_zdict(raw)) for h, raw in known.items()}
        for b in batches:
            for r in b.to_pylist():
                offsets, starts = (np.frombuffer(r[c], "<i8") for c in ("offsets", "starts"))
                docs = np.frombuffer(r["doc_ids"], "<i8")
                view, z = memoryview(r["frames"]), open_[r["dict_hash"]]
                data = [z.decompress(view[offsets[i]:offsets[i + 1]]) for i in range(r["n_docs"])]
                out = [pa.array(np.full(len(docs), r["part"], np.int32)),
                       pa.array(docs, mask=np.arange(len(docs)) < r["null_ids"]), pa.array(starts[:-1]),
                       pa.array([len(d) // 4 for d in data], pa.int64()),
                       pa.array([zlib.crc32(d) for d in data], pa.int64())]
                names = ["part", "doc_id", "at", "n_tokens", "ids_crc32"]
                if with_ids:
                    out, names = [*out, pa.array(data, pa.binary())], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(out, names=names)

    rows = blocks.select(*cols).mapInArrow(run, schema).join(F.broadcast(parts), F.col("part") == F.col("p"))
    return rows.select("doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32",
                       *(["ids"] if with_ids else []))


def lookup(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """``doc_id, ids`` of a few documents: blocks are pruned by statistics, only their frames are opened."""
    known, wanted = _dictionaries(spark, path), sorted(set(doc_ids))
    hit = F.lit(False)
    for i in wanted:
        hit = hit | ((F.col("first_id") <= i) & (F.col("last_id") >= i))
    blocks = spark.read.schema(_BLOCK).parquet(f"{path}/blocks").filter(hit)

    def run(batches):
        import zstandard
        for b in batches:
            for r in b.to_pylist():
                docs, offsets = np.frombuffer(r["doc_ids"], "<i8"), np.frombuffer(r["offsets"], "<i8")
                z = zstandard.ZstdDecompressor(dict_data=_zdict(known[r["dict_hash"]]))
                at = [i for i in np.flatnonzero(np.isin(docs, wanted)) if i >= r["null_ids"]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(docs[at], pa.int64()),
                     pa.array([z.decompress(r["frames"][offsets[i]:offsets[i + 1]]) for i in at], pa.binary())],
                    names=["doc_id", "ids"])
    return blocks.select("null_ids", "doc_ids", "offsets", "frames", "dict_hash").mapInArrow(
        run, "doc_id long, ids binary")


def store_digest(docs: DataFrame) -> DataFrame:
    """Write a store of ``docs`` into the shared folder and read it back."""
    spark = docs.sparkSession
    path = scratch_path(spark, f"token-store-{uuid.uuid4().hex}")
    write_store(docs, path)
    return read_store(spark, path)
