"""Packing: order-preserving dynamic programming over cut positions.

The ids of all documents, in ascending id order, form one stream per range of
ids.  Windows of at most ``SEQUENCE`` ids are cut from it so that padding plus
cut penalties is smallest: a cut at a document's end is free, one at a
sentence's end costs ``SENTENCE_COST`` padding ids, one inside a sentence (allowed
only in stretches without an end mark) ``HARD_COST``.
"""

from __future__ import annotations

import zlib
from array import array
from collections import deque
from itertools import batched

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import text_bytes
from pulsegrid.llm.tokens import DEFAULT_VOCABULARY, encoder, sentence_end_ids

SEQUENCE = 2048
END_ID = 1
SENTENCE_COST = 2
HARD_COST = 8
STRETCH, STEP = 32, 8     # stretches longer than STRETCH ids without an end mark may be cut every STEP ids
GROUP = 1 << 16           # ids whose cut positions are found at once; the cuts don't depend on it
RANGE_BYTES = 1 << 25     # text of a range of ids, in expectation: one stream, held by one task
ROWS = 4096               # rows returned at once

_SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
           "`offset` long, sequence_length long")
_NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "sequence_length"]


def candidates(total: int, doc_ends: np.ndarray, sentence_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted cut positions in 1..total with their penalties (``total`` itself is free)."""
    none = HARD_COST + 1
    at = np.full(total + 1, none, np.int64)
    at[sentence_ends] = SENTENCE_COST
    at[doc_ends] = 0
    at[[0, total]] = 0
    soft = np.flatnonzero(at < none)
    for i in np.flatnonzero(np.diff(soft) > STRETCH):
        at[soft[i] + STEP:soft[i + 1]:STEP] = HARD_COST
    pos = np.flatnonzero(at < none)[1:]
    return pos, at[pos]


class Plan:
    """Windows of least padding plus penalties over cut positions that come in lots.

    best(j) = cost(j) + size - pos(j) + min over i with pos(j) - pos(i) <= size of best(i) + pos(i);
    the minimum comes from a queue of increasing values, so each position enters and leaves once.  Only
    the queue has values; of all other positions eight bytes stay: the place and the best one before it.
    """

    def __init__(self, size: int = SEQUENCE):
        self.size = size
        self.queue = deque([(0, 0, 0)])          # value, position, index
        self.place, self.back = array("I", [0]), array("I", [0])

    def extend(self, pos: list[int], cost: list[int]) -> None:
        queue, size, back, j = self.queue, self.size, self.back, len(self.back)
        for here, c in zip(pos, cost):
            while queue[0][1] < here - size:
                queue.popleft()
            value, _, i = queue[0]
            back.append(i)
            key = value + size + c                       # best(j) + pos(j)
            while queue and queue[-1][0] >= key:
                queue.pop()
            queue.append((key, here, j))
            j += 1
        self.place.extend(pos)

    def cuts(self) -> list[int]:
        """Ends of the windows; the last position is the last end."""
        ends, j = [], len(self.back) - 1
        while j > 0:
            ends.append(self.place[j])
            j = self.back[j]
        return ends[::-1]


def plan_cuts(pos: np.ndarray, cost: np.ndarray, size: int = SEQUENCE) -> list[int]:
    """Ends of the best windows over all positions at once."""
    plan = Plan(size)
    plan.extend(pos.tolist(), cost.tolist())
    return plan.cuts()


class _Stream:
    """The documents of a range and the plan over them so far."""

    def __init__(self, flags: np.ndarray, size: int):
        self.flags, self.plan = flags, Plan(size)
        self.docs: list[tuple] = []              # doc_id, ids as bytes
        self.new, self.waiting, self.total = 0, 0, 0   # documents and ids not yet in the plan, ids in it

    def add(self, doc_id, raw: bytes):
        self.docs.append((doc_id, raw))
        self.waiting += len(raw) // 4
        if self.waiting >= GROUP:
            self.settle()

    def settle(self):
        """Cut positions of the waiting documents; a document's start and end are free, so lots don't matter."""
        group = [np.frombuffer(raw, "<u4") for _, raw in self.docs[self.new:]]
        if group:
            ids = np.concatenate(group)
            soft = np.flatnonzero(self.flags[np.minimum(ids, len(self.flags) - 1)]) + 1
            pos, cost = candidates(len(ids), np.cumsum([len(g) for g in group]), soft)
            self.plan.extend((pos + self.total).tolist(), cost.tolist())
            self.total += len(ids)
        self.new, self.waiting = len(self.docs), 0

    def rows(self, sequence: int):
        """The pieces of all windows, numbered from ``sequence``."""
        self.settle()
        at, k, begin, offset = 0, -1, 0, 0       # ids cut so far; the current document, where it begins and ends
        end = 0
        for stop in self.plan.cuts():
            offset, length = 0, stop - at
            while at < stop:
                while end <= at:
                    k, begin = k + 1, end
                    end = begin + len(self.docs[k][1]) // 4
                doc_id, raw = self.docs[k]
                lo, hi = at - begin, min(stop, end) - begin
                yield (doc_id, lo, hi - lo, zlib.crc32(raw[4 * lo:4 * hi]), end - begin, sequence, offset, length)
                offset += hi - lo
                at += hi - lo
            sequence += 1


def pack(docs: DataFrame, vocabulary: str = DEFAULT_VOCABULARY, id_col: str = "doc_id", text_col: str = "text",
         size: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, sequence_length``.

    Rows are dealt into ranges of ids (of one id: by a hash of the text) and
    sorted; a range holds about ``RANGE_BYTES`` of text, is one stream with one
    plan, and leaves at most one short sequence.  Sequence ids are unique: range
    number times 2^33 plus position.  Null and empty texts are the end id alone;
    a null id sorts first; repeated rows are packed as often as they come; an
    empty table gives no rows; other columns are not read.
    """
    def run(batches):
        enc, end = encoder(vocabulary), int(end_id).to_bytes(4, "little")
        stream = _Stream(sentence_end_ids(vocabulary), size)
        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), text_bytes(b.column(1))):
                stream.add(doc_id, enc.encode(text) + end)
        for lot in batched(stream.rows(TaskContext.get().partitionId() << 33), ROWS):
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*lot)], names=_NAMES)

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    held = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-held // RANGE_BYTES))
    # rows of one id, or without one, are dealt by a hash of their text
    return (rows.withColumn("_h", F.xxhash64("text")).repartitionByRange(ranges, "id", "_h")
                .sortWithinPartitions("id", "_h", "text").select("id", "text").mapInArrow(run, _SCHEMA))
