"""Quality classifier: a factorisation machine over hashed words, structure and length.

score(x) = w0 + sum w_i x_i + 1/2 sum_f [(sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2]:
all pairwise interactions of rank ``RANK`` in time linear in the features.
Fitted on the driver over a bounded, hash-chosen sample of labelled rows;
every document is scored inside the tasks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import crc_text, hash_sample, text_bytes, word_hashes

BUCKETS = 1 << 15
RANK = 8
SAMPLE_ROWS = 4000        # labelled rows the model is fitted on, at most
EPOCHS = 12
BATCH = 64
RATE = 0.05
WORD_DECAY, PAIR_DECAY = 1e-4, 1e-4
CUT = 0.3                 # predicted 1 from this score on

STRUCTURE = ("log_chars", "log_words", "word_length", "unique_words", "repeated_next", "top_word", "upper", "digits",
             "marks", "spaces", "line_ends", "repeated_lines", "sentence_ends", "odd_marks", "bytes_per_word_end")


def features(raw: bytes | None, hashes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word buckets, their weights, structure vector) of one whole text; null counts as empty."""
    raw = raw or b""
    words = raw.lower().split()
    n = len(words)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, n)
    order = np.sort(h)
    first = np.flatnonzero(np.concatenate([[True], order[1:] != order[:-1]])) if n else np.empty(0, np.int64)
    counts = np.diff(np.concatenate([first, [n]])) if n else np.empty(0, np.int64)
    weights = np.log1p(counts)
    norm = np.sqrt((weights * weights).sum()) or 1.0
    buckets = (order[first] % np.uint64(BUCKETS)).astype(np.int32) if n else np.empty(0, np.int32)

    by = np.bincount(np.frombuffer(raw, np.uint8), minlength=256) if raw else np.zeros(256, np.int64)
    size, total = max(len(raw), 1), max(n, 1)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    letters_up, digits = by[65:91].sum(), by[48:58].sum()
    marks = by[33:48].sum() + by[58:65].sum() + by[91:97].sum() + by[123:127].sum()
    odd = marks - by[44] - by[46] - by[39] - by[45]
    ends = by[46] + by[33] + by[63]
    structure = np.array([
        np.log1p(len(raw)), np.log1p(n), len(raw) / total / 10, len(first) / total,
        (h[1:] == h[:-1]).sum() / total if n > 1 else 0.0, counts.max() / total if n else 0.0,
        letters_up / size * 10, digits / size * 10, marks / size * 10, (by[32] + by[10]) / size * 5,
        by[10] / total * 5, 1 - len(set(lines)) / max(len(lines), 1), ends / total * 5, odd / total,
        (by[128:].sum()) / size])
    return buckets, (weights / norm).astype(np.float32), structure.astype(np.float32)


class Machine:
    """Weights of the fitted machine; ``score`` gives probabilities."""

    def __init__(self, bias, linear, pairs, mean, scale):
        self.bias, self.linear, self.pairs, self.mean, self.scale = bias, linear, pairs, mean, scale

    def inputs(self, buckets, weights, structure):
        """Indices and values: words first, then the standardised structure features."""
        dense = np.clip((structure - self.mean) / self.scale, -4, 4) / 2
        return (np.concatenate([buckets, BUCKETS + np.arange(len(dense), dtype=np.int32)]),
                np.concatenate([weights, dense.astype(np.float32)]))

    def score(self, buckets, weights, structure) -> float:
        i, x = self.inputs(buckets, weights, structure)
        vx = self.pairs[i] * x[:, None]
        z = self.bias + self.linear[i] @ x + 0.5 * float((vx.sum(0) ** 2 - (vx * vx).sum(0)).sum())
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def fit(rows: list[tuple], seed: int = 7) -> Machine:
    """Adagrad on the log loss over (buckets, weights, structure, label) rows.

    Classes weigh alike up to a factor of 4.  No rows, or one class alone: a
    constant score of the class share (1/2 without rows).
    """
    s = len(STRUCTURE)
    linear, pairs = np.zeros(BUCKETS + s, np.float32), np.zeros((BUCKETS + s, RANK), np.float32)
    if not rows:
        return Machine(0.0, linear, pairs, np.zeros(s, np.float32), np.ones(s, np.float32))
    y = np.array([r[3] for r in rows], np.float32)
    dense = np.stack([r[2] for r in rows])
    mean, scale = dense.mean(0), dense.std(0) + 1e-3
    m = Machine(0.0, linear, pairs, mean, scale)
    share = float(np.clip(y.mean(), 0.01, 0.99))
    m.bias = float(np.log(share / (1 - share)))
    if y.min() == y.max():
        return m
    rng = np.random.default_rng(seed)
    pairs += rng.normal(0, 0.01, pairs.shape).astype(np.float32)
    xs = [m.inputs(*r[:3]) for r in rows]
    importance = np.where(y == 1, 1.0, min(4.0, share / (1 - share))) if share > 0.5 else \
        np.where(y == 0, 1.0, min(4.0, (1 - share) / share))
    g_lin, g_pair, g_bias = np.full(len(linear), 1e-3), np.full(pairs.shape, 1e-3, np.float32), 1e-3
    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for lo in range(0, len(order), BATCH):
            pick = order[lo:lo + BATCH]
            idx = np.concatenate([xs[k][0] for k in pick])
            val = np.concatenate([xs[k][1] for k in pick])
            starts = np.concatenate([[0], np.cumsum([len(xs[k][0]) for k in pick])[:-1]])
            lens = np.array([len(xs[k][0]) for k in pick])
            v = pairs[idx]
            vx = v * val[:, None]
            sums = np.add.reduceat(vx, starts, axis=0)
            z = m.bias + np.add.reduceat(linear[idx] * val, starts) + 0.5 * (
                sums ** 2 - np.add.reduceat(vx * vx, starts, axis=0)).sum(1)
            err = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[pick]) * importance[pick] / len(pick)
            e = np.repeat(err, lens).astype(np.float32)
            grad = (e * val)[:, None] * (np.repeat(sums, lens, axis=0) - vx)
            # sums per feature of the batch
            by = np.argsort(idx, kind="stable")
            cuts = np.flatnonzero(np.concatenate([[True], idx[by][1:] != idx[by][:-1]]))
            own = idx[by][cuts]
            gl = np.add.reduceat((e * val)[by], cuts) + WORD_DECAY * linear[own]
            gp = np.add.reduceat(grad[by], cuts, axis=0) + PAIR_DECAY * pairs[own]
            g_lin[own] += gl * gl
            g_pair[own] += gp * gp
            linear[own] -= RATE * gl / np.sqrt(g_lin[own])
            pairs[own] -= RATE * gp / np.sqrt(g_pair[own])
            g_bias += float(err.sum()) ** 2
            m.bias -= RATE * float(err.sum()) / g_bias ** 0.5
    return m


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", folds: int = 5, held_out: int = 0) -> Machine:
    """Fit on at most ``SAMPLE_ROWS`` labelled rows outside the held-out fold.

    Rows with a null id, or a label other than 0 and 1, are not learned from;
    an id with several labels uses the largest, one with several texts the first
    by its features.
    """
    rows = (labels.select(F.col("doc_id").cast("long").alias("_id"), F.col(label_col).cast("int").alias("_y"))
                  .filter("_id IS NOT NULL AND _y IN (0, 1)").filter(F.pmod(crc_text("_id"), F.lit(folds)) != held_out)
                  .groupBy("_id").agg(F.max("_y").alias("_y")))
    known = docs.select(F.col(id_col).cast("long").alias("_doc"))
    chosen = hash_sample(rows.join(known, F.col("_id") == F.col("_doc"), "left_semi"), ["_id"], SAMPLE_ROWS)
    texts = docs.select(F.col(id_col).cast("long").alias("_doc"), F.col(text_col).alias("_text"))
    picked = texts.join(F.broadcast(chosen), F.col("_doc") == F.col("_id")).select("_doc", "_text", "_y")

    def run(batches):
        hashes = word_hashes()
        for b in batches:
            made = [features(t, hashes) for t in text_bytes(b.column(1))]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), *[pa.array([m[i].tobytes() for m in made], pa.binary()) for i in range(3)]],
                names=["id", "y", "buckets", "weights", "structure"])
    made = picked.mapInArrow(run, "id long, y int, buckets binary, weights binary, structure binary")
    # one row an id reaches the driver, however often it is repeated
    got = made.groupBy("id").agg(F.min(F.struct("structure", "buckets", "weights", "y")).alias("r")).select("id", "r.*").collect()
    got = sorted(got, key=lambda r: r["id"])
    return fit([(np.frombuffer(r["buckets"], np.int32), np.frombuffer(r["weights"], np.float32),
                 np.frombuffer(r["structure"], np.float32), r["y"]) for r in got])


def score(docs: DataFrame, model: Machine, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",),
          name: str = "score") -> DataFrame:
    """Columns ``keep`` plus the score of every whole text.

    The score depends on the text alone; null and empty texts have that of no
    words; repeated rows score alike; an empty table gives no rows.
    """
    from pyspark.sql import types as T
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast(            # (BUCKETS + structure) x (RANK + 1) floats
        (model.bias, model.linear, model.pairs, model.mean, model.scale))
    names = list(keep) if text_col in keep else [*keep, text_col]
    at, out = names.index(text_col), [docs.schema[c] for c in keep]
    schema = T.StructType([*out, T.StructField(name, T.DoubleType())])

    def run(batches):
        hashes, m = word_hashes(), Machine(*held.value)
        for b in batches:
            scores = [m.score(*features(t, hashes)) for t in text_bytes(b.column(at))]
            yield pa.RecordBatch.from_arrays([*b.columns[:len(out)], pa.array(scores, pa.float64())],
                                             names=[*b.schema.names[:len(out)], name])
    return docs.select(*names).mapInArrow(run, schema)


def quality_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    out = score(docs, train(docs, labels), keep=("doc_id",))
    return out.select("doc_id", (F.pmod(crc_text("doc_id"), F.lit(5)) == 0).alias("held_out"), "score",
                      (F.col("score") >= CUT).cast("int").alias("predicted"))
