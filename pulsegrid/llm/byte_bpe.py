"""Byte-level BPE by a global shuffle of distinct words, and decoding by a join with the token bytes.

The pre-tokens of a text are the matches of the vocabulary's pattern.  Texts
are cut into pre-tokens block by block; a block (a bounded number of rows of
one task) keeps which of its distinct words stands at which position.  Only the
block's distinct words with their slots are exploded and shuffled, dealt to
buckets by a hash of the word, so equal words of all blocks meet: there a word
is merged once and its ids go back to every block that holds it, where the
texts are put together again by position.  A word that makes up a third of all
pre-tokens is one entry a block.  A row of the shuffle packs the words of one
block and bucket, which is a fraction of a row per word.  The blocks themselves
are dealt by their key once; both the words and the join read that exchange.  A
block's key is a digest of what is in it, so words of a block that was computed
anew with other rows can't be taken for the old one's: that raises.  Decoding
joins ids with the token bytes, whose table is as long as the vocabulary file,
so every task holds it and nothing is shuffled.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsegrid.llm.common import BoundedMap, worker_state
from pulsegrid.llm.tokens import vocabulary_path

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
BLOCK_ITEMS = 1 << 22     # pre-tokens of a block, but for a longer single text
WORDS_HELD = 200_000      # words of a bucket whose ids are kept at once (two generations)
PART_ITEMS = 1 << 18      # pre-tokens that are put together at once
SLICE_CHARS = 1 << 20     # a longer text is cut before white space that follows other characters


def read_ranks(name: str = VOCABULARY) -> dict[bytes, int]:
    """Token bytes and ranks of a vocabulary file: base64, a space, the rank."""
    with open(vocabulary_path(name), "rb") as f:
        return {base64.b64decode(t): int(r) for t, r in (line.split() for line in f if line.strip())}


def _token_table(name: str) -> pa.Array:
    """Token bytes by id (null where the vocabulary has none), loaded once a worker."""
    state = worker_state().__dict__.setdefault("token_tables", {})
    if name not in state:
        ranks = read_ranks(name)
        tokens: list = [None] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            tokens[i] = token
        state[name] = pa.array(tokens, pa.binary())
    return state[name]


def _splitter(pattern: str):
    state = worker_state().__dict__.setdefault("splitters", {})
    if pattern not in state:
        import regex
        state[pattern] = regex.compile(pattern).findall
    return state[pattern]


def _merger(name: str):
    """bytes of one pre-token -> ids."""
    state = worker_state().__dict__.setdefault("mergers", {})
    if name not in state:
        import tiktoken
        state[name] = tiktoken.Encoding(name, pat_str=r"[\s\S]+", mergeable_ranks=read_ranks(name), special_tokens={})
    return state[name]._encode_single_piece


def slices(text: str, size: int = SLICE_CHARS):
    """Parts of a text whose pre-tokens are those of the text.

    A pre-token holds white space only at its start or throughout, so a cut
    between another character and white space is always between two of them.
    """
    at = 0
    while len(text) - at > size:
        cut = at + size
        while cut < len(text) and not (text[cut] in " \n" and text[cut - 1].isalnum()):
            cut += 1
        yield text[at:cut]
        at = cut
    yield text[at:]


def _pack(*columns: np.ndarray, tail: bytes = b"") -> bytes:
    """Columns of 32-bit numbers, byte plane by byte plane, and a tail, compressed."""
    head = np.array([len(columns), *map(len, columns)], "<u4").tobytes()
    planes = [np.asarray(c).astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes() for c in columns]
    return zstandard.ZstdCompressor(level=3).compress(b"".join([head, *planes, tail]))


def _unpack(raw: bytes) -> tuple[list[np.ndarray], bytes]:
    """The columns and the tail of ``_pack``."""
    data = zstandard.ZstdDecompressor().decompress(raw)
    n = int(np.frombuffer(data, "<u4", 1)[0])
    sizes, at, out = np.frombuffer(data, "<u4", n, 4), 4 + 4 * n, []
    for size in sizes.tolist():
        planes = np.frombuffer(data, np.uint8, 4 * size, at).reshape(4, size)
        out.append(np.ascontiguousarray(planes.T).view("<u4").ravel())
        at += 4 * size
    return out, data[at:]


def _pack_words(words: pa.StringArray, buckets: int) -> list[dict]:
    """Distinct words of a block by bucket: their bytes in order, lengths and slots."""
    order = pc.array_sort_indices(words).to_numpy()
    deal = np.fromiter((xxhash.xxh3_64_intdigest(w) % buckets for w in words.to_pylist()), np.int64, len(words))
    order = order[np.argsort(deal[order], kind="stable")]
    taken = words.take(pa.array(order))
    ends = np.frombuffer(taken.buffers()[1], np.int32, len(taken) + 1, taken.offset * 4)
    data = taken.buffers()[2]
    found, first = np.unique(deal[order], return_index=True)
    out = []
    for k, a, b in zip(found.tolist(), first.tolist(), [*first[1:].tolist(), len(order)]):
        text = data.slice(int(ends[a]), int(ends[b] - ends[a])).to_pybytes()
        out.append({"bucket": k, "words": _pack(np.diff(ends[a:b + 1]), order[a:b], tail=text)})
    return out


def to_blocks(docs: DataFrame, keep: list[str], text_col: str, pattern: str, buckets: int) -> DataFrame:
    """Block rows ``block, rows, slots, parts``, dealt by ``block``: the rows' other columns with their number
    of pre-tokens (``_n``), the slot of the word at every position, and the distinct words by bucket."""
    from pyspark.sql.pandas.types import to_arrow_schema
    row = T.StructType([*[docs.schema[c] for c in keep], T.StructField("_n", T.LongType())])
    part = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("words", T.BinaryType())])
    schema = T.StructType([T.StructField("block", T.LongType()), T.StructField("rows", T.ArrayType(row)),
                           T.StructField("slots", T.BinaryType()), T.StructField("parts", T.ArrayType(part))])
    arrow = to_arrow_schema(schema)

    def emit(place, kept, lengths, coded):
        whole = pa.chunked_array(coded).unify_dictionaries()
        slots = np.concatenate([c.indices.to_numpy(zero_copy_only=False) for c in whole.chunks])
        slots, parts = _pack(slots), _pack_words(whole.chunk(0).dictionary, buckets)
        key = xxhash.xxh64(repr(place).encode() + slots)
        for p in parts:
            key.update(p["words"])
        return pa.RecordBatch.from_arrays(
            [pa.array([key.intdigest() - (1 << 63)], pa.int64()),
             pa.array([[r | {"_n": n} for r, n in zip(kept, lengths, strict=True)]], arrow.field("rows").type),
             pa.array([slots], arrow.field("slots").type), pa.array([parts], arrow.field("parts").type)], schema=arrow)

    def kern(batches):
        from pyspark import TaskContext
        find, partition = _splitter(pattern), TaskContext.get().partitionId()
        block, kept, lengths, coded, held, waiting, total = 0, [], [], [], [], 0, 0

        def code():
            coded.append(pa.concat_arrays(held).dictionary_encode())
            held.clear()

        for b in batches:
            own = b.select(keep).to_pylist() if keep else [{}] * b.num_rows
            for r, text in zip(own, b.column(text_col)):
                text = text.as_py() or ""
                words = find(text) if len(text) <= SLICE_CHARS else [w for part in slices(text) for w in find(part)]
                if kept and total + len(words) > BLOCK_ITEMS:
                    if held:
                        code()
                    yield emit((partition, block), kept, lengths, coded)
                    block, kept, lengths, coded, waiting, total = block + 1, [], [], [], 0, 0
                kept.append(r)
                lengths.append(len(words))
                held.append(pa.array(words, pa.string()))
                waiting, total = waiting + len(words), total + len(words)
                if waiting >= PART_ITEMS:
                    code()
                    waiting = 0
        if kept:
            if held:
                code()
            yield emit((partition, block), kept, lengths, coded)

    return docs.select(*keep, text_col).mapInArrow(kern, schema).repartition("block")


def word_ids(blocks: DataFrame, name: str) -> DataFrame:
    """``block, ids``: packed slots, lengths and ids of a block's words of one bucket.

    The rows of a bucket lie in one run of a partition, so a word of many
    blocks is merged for the first of them and looked up for the others."""
    def merge(batches):
        bucket, known = None, {}
        one = _merger(name)
        for b in batches:
            out = []
            for k, raw in zip(b.column("bucket").to_pylist(), b.column("words")):
                if k != bucket:
                    bucket, known = k, BoundedMap(lambda w: np.array(one(w), "<u4").tobytes(), WORDS_HELD)
                (lengths, slots), text = _unpack(raw.as_py())
                ends = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)]).tolist()
                ids = [known[text[x:y]] for x, y in zip(ends, ends[1:])]
                out.append(_pack(slots, np.fromiter(map(len, ids), np.int64, len(ids)) // 4,
                                 np.frombuffer(b"".join(ids), "<u4")))
            yield pa.RecordBatch.from_arrays([b.column("block"), pa.array(out, pa.binary())], names=["block", "ids"])

    def explode(batches):      # reads whole block rows, so that the exchange below is the join's as well
        for b in batches:
            lists = b.column("parts")
            parts = lists.flatten()
            size = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(b.column("block").to_numpy(), size)), parts.field("bucket"), parts.field("words")],
                names=["block", "bucket", "words"])

    parts = blocks.mapInArrow(explode, "block long, bucket int, words binary")
    return (parts.repartition("bucket").sortWithinPartitions("bucket")
                 .mapInArrow(merge, "block long, ids binary"))


def encode(docs: DataFrame, text_col: str = "text", name: str = VOCABULARY, pattern: str | None = None) -> DataFrame:
    """All columns of ``docs`` but the text, and ``ids array<int>``, one row per row.

    Null text counts as empty, empty text has no ids.  Rows keep their own
    columns through the blocks, so null and repeated ids of documents and
    equal rows don't matter; columns named ``ids`` or ``_n`` give way.  No
    rows, no rows.
    """
    if pattern is None:
        import public_tokenizers
        pattern = public_tokenizers.PATTERN
    from pyspark.sql.pandas.types import to_arrow_schema
    keep = [c for c in docs.columns if c not in (text_col, "ids", "_n")]
    # as many buckets as keep a task's share of the words small at the session's own partition count
    buckets = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = to_blocks(docs, keep, text_col, pattern, buckets)
    found = word_ids(blocks, name).groupBy("block").agg(F.collect_list("ids").alias("found"))
    joined = blocks.join(found.hint("merge"), "block", "left")
    schema = T.StructType([*[docs.schema[c] for c in keep], T.StructField("ids", T.ArrayType(T.IntegerType()))])
    arrow = to_arrow_schema(schema)

    def rows_of(rows, positions, found):
        """Batches of a block's rows, about PART_ITEMS pre-tokens each."""
        ends = np.concatenate([[0], np.cumsum(rows.field("_n").to_numpy(zero_copy_only=False))])
        parts = [_unpack(v.as_py())[0] for v in found.values] if found.is_valid else []
        slot, length, flat = (np.concatenate(c) for c in zip(*parts)) if parts else np.zeros((3, 0), np.uint32)
        if len(slot) != (positions.max() + 1 if len(positions) else 0):
            raise RuntimeError("a block's words are missing: its rows were not the same when it was computed anew")
        at = np.concatenate([[0], np.cumsum(length, dtype=np.int64)]).astype(np.int32)
        words = pa.ListArray.from_arrays(pa.array(at), pa.array(flat.astype(np.int32)))
        place = np.empty(len(slot), np.int32)
        place[slot] = np.arange(len(slot), dtype=np.int32)
        cuts = np.unique(np.concatenate([[0], np.flatnonzero(np.diff(ends[1:] // PART_ITEMS)) + 1, [len(rows)]]))
        for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            taken = words.take(pa.array(place[positions[ends[lo]:ends[hi]]]))      # ids of every position
            at = taken.offsets.to_numpy()[ends[lo:hi + 1] - ends[lo]]
            part = rows.slice(lo, hi - lo)
            yield pa.RecordBatch.from_arrays(
                [*[part.field(c).cast(arrow.field(c).type) for c in keep],
                 pa.ListArray.from_arrays(pa.array(at - at[0], pa.int32()), taken.flatten())], schema=arrow)

    def kern(batches):
        for b in batches:
            for i in range(b.num_rows):
                (positions,), _ = _unpack(b.column("slots")[i].as_py())
                yield from rows_of(b.column("rows")[i].values, positions, b.column("found")[i])

    return joined.mapInArrow(kern, schema)


def decode(encoded: DataFrame, ids_col: str = "ids", name: str = VOCABULARY) -> DataFrame:
    """All columns of ``encoded`` but the ids, and ``decoded binary``, one row per row.

    Null ids count as none; an id that the vocabulary doesn't have raises.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    keep = [c for c in encoded.columns if c not in (ids_col, "decoded")]
    schema = T.StructType([*[encoded.schema[c] for c in keep], T.StructField("decoded", T.BinaryType())])
    arrow = to_arrow_schema(schema)

    def kern(batches):
        table = _token_table(name)
        for b in batches:
            ids = b.column(ids_col)
            flat = ids.flatten()
            bad = pc.filter(flat, pc.or_(pc.less(flat, 0), pc.greater_equal(flat, len(table))))
            tokens = None if len(bad) else table.take(flat)
            if tokens is None or tokens.null_count:
                wrong = bad if len(bad) else flat.filter(pc.is_null(tokens))
                raise ValueError(f"no token has id {wrong[0].as_py()}")
            lengths = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False)
            ends = np.concatenate([[0], np.cumsum(lengths)])
            # the tokens of a row lie side by side: its bytes are the same buffer with wider offsets
            at = np.frombuffer(tokens.buffers()[1], np.int32, len(tokens) + 1, tokens.offset * 4)[ends] if len(tokens) \
                else np.zeros(len(ends), np.int32)
            data = tokens.buffers()[2] or pa.py_buffer(b"")
            texts = pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(at.astype(np.int32)), data])
            yield pa.RecordBatch.from_arrays([*[b.column(c).cast(arrow.field(c).type) for c in keep], texts], schema=arrow)

    return encoded.select(*keep, ids_col).mapInArrow(kern, schema)


def round_trip(docs: DataFrame) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every document, from its ids and their decoding."""
    ids = encode(docs.select("doc_id", "text")).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"), "ids")
    return decode(ids).select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))
