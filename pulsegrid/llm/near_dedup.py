"""Near duplicates: MinHash bands propose, odd sketches sift, full shingle sets decide.

1. Texts with one shingle set form a class; its smallest id stands for it.
2. Each class gets MinHash samples; ``bands`` x ``rows`` of them deal it into
   buckets, and all samples folded into a parity bitmap give its odd sketch.
3. Inside a bucket, pairs whose XOR population count rules the threshold out
   (beyond the error of sketch and samples) are dropped; the rest are decided on
   full shingle sets.  Classes already joined are not compared again, so a
   bucket gives a spanning forest of confirmed links, not its pairs.
4. A bucket larger than ``BLOCK`` is cut into blocks.  Pairs within a block come
   first; of what is still apart afterwards, every pair of blocks is compared, each
   in a group of its own, so no group grows with the bucket and no link is lost.
5. Components are the smallest reachable ids over the confirmed links.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import materialise, shingle_set, text_bytes, word_hashes

BLOCK = 256               # classes compared with each other at once
SKETCH_BITS = 512
ERRORS = 5.0              # standard errors a sketch may be off before a pair is ruled out
LEVEL = 6


def _hash_family(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20)
    return (rng.integers(1, 2 ** 63, n, dtype=np.uint64) | np.uint64(1),
            rng.integers(0, 2 ** 63, n, dtype=np.uint64))


def minhash(shingles: np.ndarray, family) -> np.ndarray:
    """Smallest multiply-add hash of the set under each function (upper 32 bits)."""
    a, b = family
    out = np.full(len(a), np.iinfo(np.uint32).max, np.uint32)
    for i in range(0, len(shingles), 4096):
        h = (shingles[i:i + 4096, None] * a + b) >> np.uint64(32)
        np.minimum(out, h.min(0).astype(np.uint32), out=out)
    return out


def odd_sketch(samples: np.ndarray) -> np.ndarray:
    """Parity bitmap of the (place, sample) pairs, as 64-bit words."""
    x = (samples.astype(np.uint64) + (np.arange(len(samples), dtype=np.uint64) << np.uint64(32)))
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    flips = np.bincount((x >> np.uint64(64 - 9)).astype(np.int64), minlength=SKETCH_BITS) & 1
    return np.packbits(flips.astype(np.uint8)).view(np.uint64)


def most_bits(k: int, threshold: float) -> int:
    """Largest XOR population count a pair at the threshold may show, with ``ERRORS`` standard errors.

    Samples that differ are binomial(k, 1 - J), each flips two bits; bits that
    meet even out: expected count (n / 2) (1 - exp(-2 m / n)) for m flips.
    """
    differ = k * (1 - threshold)
    m = 2 * min(k, differ + ERRORS * math.sqrt(k * threshold * (1 - threshold)))
    n = SKETCH_BITS
    expected = n / 2 * (1 - math.exp(-2 * m / n))
    return math.ceil(expected + ERRORS * math.sqrt(max(1.0, expected * (1 - expected / n))) / 2)


def signatures(docs: DataFrame, width: int, bands: int, rows: int, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, n_shingles, set_key, sketch, buckets`` of every row (key and rest null for empty sets)."""
    schema = "doc_id long, n_shingles long, set_key binary, sketch binary, buckets array<long>"
    fields = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_key", pa.binary()),
                        ("sketch", pa.binary()), ("buckets", pa.list_(pa.int64()))])

    def run(batches):
        import xxhash
        hashes, family = word_hashes(), _hash_family(bands * rows)
        for b in batches:
            ids, texts = b.column(0), text_bytes(b.column(1))
            for lo in range(0, len(texts), 1000):
                out = [[], [], [], []]
                for raw in texts[lo:lo + 1000]:
                    s = shingle_set(raw, width, hashes)
                    out[0].append(len(s))
                    if not len(s):
                        for o in out[1:]:
                            o.append(None)
                        continue
                    sig = minhash(s, family)
                    own = sig.reshape(bands, rows)
                    out[1].append(xxhash.xxh3_128_digest(s.tobytes()))
                    out[2].append(odd_sketch(sig).tobytes())
                    out[3].append([xxhash.xxh64_intdigest(own[i].tobytes(), i) - (1 << 63) for i in range(bands)])
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(lo, 1000), *[pa.array(o, f.type) for o, f in zip(out, list(fields)[1:])]], schema=fields)
    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(run, schema)


def _links(sizes, sketches, sets, labels, limit, percent, cross=None):
    """Confirmed links (i, j) of one group that join what was apart, as a spanning forest.

    ``cross``: block number of each member; then only pairs from different blocks count.
    """
    parent = {}

    def find(x):
        while parent.get(x, x) != x:
            parent[x] = parent.get(parent[x], parent[x])
            x = parent[x]
        return x
    n, out = len(sizes), []
    flat = starts = None
    for i in range(n - 1):
        js = np.arange(i + 1, n)
        small, large = np.minimum(sizes[js], sizes[i]), np.maximum(sizes[js], sizes[i])
        ok = 100 * small >= percent * large
        if cross is not None:
            ok &= cross[js] != cross[i]
        js = js[ok]
        if not len(js):
            continue
        js = js[np.bitwise_count(sketches[js] ^ sketches[i]).sum(1) <= limit]
        mine = find(labels[i])
        js = np.array([j for j in js.tolist() if find(labels[j]) != mine], np.int64)
        if not len(js):
            continue
        if flat is None:
            full = [sets(k) for k in range(n)]
            lens = np.array([len(f) for f in full])
            starts = np.concatenate([[0], np.cumsum(lens)])
            flat = np.concatenate(full)
        own = flat[starts[i]:starts[i + 1]]
        pick = np.concatenate([flat[starts[j]:starts[j + 1]] for j in js])
        at = np.minimum(np.searchsorted(own, pick), len(own) - 1)
        edge = np.concatenate([[0], np.cumsum(lens[js])[:-1]])
        both = np.add.reduceat((own[at] == pick).astype(np.int64), edge)
        linked = 100 * both >= percent * (lens[i] + lens[js] - both)
        for j in js[linked].tolist():
            a, b = find(labels[i]), find(labels[j])
            if a != b:
                parent[max(a, b)] = min(a, b)
                out.append((i, j))
    return out


def _verify(rows: DataFrame, group: list[str], width: int, limit: int, percent: int, crossing: bool) -> DataFrame:
    """``a, b`` of confirmed links; ``rows`` hold group columns, node, label, block, n, sketch, packed text."""
    spark = rows.sparkSession
    n_tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = (rows.select(*group, "node", "label", "_block", "n_shingles", "sketch", "_z")
                .repartition(n_tasks, *group).sortWithinPartitions(*group, "node"))
    k = len(group)

    def run(batches):
        import zstandard
        opened, hashes = zstandard.ZstdDecompressor(), word_hashes()

        def solve(members):
            if len(members) < 2:
                return []
            node, label, block, n, sketch, packed = zip(*members)
            kinds = set(label)
            if len(kinds) < 2 or (crossing and len(set(block)) < 2):
                return []
            out = _links(np.array(n), np.stack([np.frombuffer(s, np.uint64) for s in sketch]),
                         lambda i: shingle_set(opened.decompress(packed[i]), width, hashes), list(label), limit,
                         percent, np.array(block) if crossing else None)
            return [(node[i], node[j]) for i, j in out]
        held, members = None, []
        for b in batches:
            cols = [b.column(i).to_pylist() for i in range(b.num_columns)]
            found = []
            for row in zip(*cols):
                if row[:k] != held:
                    found += solve(members)
                    held, members = row[:k], []
                members.append(row[k:])
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], names=["a", "b"])
        if found := solve(members):
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], names=["a", "b"])
    return rows.mapInArrow(run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """``node, label``: the smallest id each end of a link can reach.

    Smallest neighbour labels travel along the links and labels jump to the
    label of their label, so rounds grow with the logarithm of a component's
    width; every round is a written table, sums are combined before shuffles.
    """
    both = materialise(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "near-edges")
    labels = materialise(both.groupBy(F.col("a").alias("node"))
                             .agg(F.least(F.min("b"), F.col("a")).alias("label")), "near-labels")
    while True:
        near = (both.join(labels.select(F.col("node").alias("b"), "label"), "b")
                    .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("_near")))
        new = labels.join(near, "node").select("node", "label", F.least("label", "_near").alias("_new"))
        jump = labels.select(F.col("node").alias("_new"), F.col("label").alias("_far"))
        new = materialise(new.join(jump, "_new").select("node", F.least("_new", "_far").alias("label"),
                                                        (F.least("_new", "_far") != F.col("label")).alias("_moved")),
                          "near-labels")
        moved = new.filter("_moved").limit(1).count()
        labels = new.select("node", "label")
        if not moved:
            return labels


def near_groups(docs: DataFrame, width: int = 5, percent: int = 80, bands: int = 30, rows: int = 4,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row.

    Two rows are linked when 100 * |A & B| >= percent * |A | B| over their
    shingle sets; ``component_id`` is the smallest id reachable, ``kept`` marks
    it.  At the threshold a pair shares no bucket with probability
    (1 - J^rows)^bands (1.4e-7 by default).  Null and empty texts and texts
    without words have an empty set and are linked with nothing; a null id is
    linked with nothing and kept; repeated rows carry equal results (ids are
    taken as unique: of an id with several texts one stands for it); an empty
    table gives no rows; other columns are not read.
    """
    sig = materialise(signatures(docs, width, bands, rows, id_col, text_col), "near-signatures")
    classes = materialise(
        sig.filter(F.col("set_key").isNotNull() & F.col("doc_id").isNotNull()).groupBy("set_key")
           .agg(F.min("doc_id").alias("node"), F.first("n_shingles").alias("n_shingles"),
                F.first("sketch").alias("sketch"), F.first("buckets").alias("buckets")), "near-classes")
    # Spark sizes what is exploded, or packed on disk, far too low: hints keep such rows out of broadcasts
    places = classes.select("node", F.posexplode("buckets").alias("band", "bucket")).hint("merge")
    full = places.groupBy("band", "bucket").agg(F.count(F.lit(1)).alias("_size")).filter("_size > 1")
    # (bucket, node) of every bucket with company
    busy = materialise(places.join(full, ["band", "bucket"]), "near-buckets")
    nodes = busy.select("node").distinct()

    def squeeze(batches):
        import zstandard
        made = zstandard.ZstdCompressor(level=LEVEL)
        for b in batches:
            packed = pa.array([made.compress(t.lower()) for t in text_bytes(b.column(1))], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), packed], names=["id", "_z"])
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).filter(
        "id IS NOT NULL AND text IS NOT NULL").mapInArrow(squeeze, "id long, _z binary")
    info = classes.select(F.col("node"), "n_shingles", "sketch")
    bodies = materialise(texts.join(nodes, texts["id"] == nodes["node"], "left_semi")
                              .join(info, F.col("id") == F.col("node")).select("node", "n_shingles", "sketch", "_z")
                              .dropDuplicates(["node"]), "near-texts")
    limit = most_bits(bands * rows, percent / 100)
    blocks = F.ceil(F.col("_size") / BLOCK).cast("int")
    placed = busy.select("band", "bucket", "node", blocks.alias("_blocks"),
                         F.pmod(F.xxhash64("node"), blocks).cast("int").alias("_block"))
    first = placed.hint("merge").join(bodies, "node").withColumn("label", F.col("node"))
    links = materialise(_verify(first, ["band", "bucket", "_block"], width, limit, percent, False), "near-links")
    labels = components(links)
    # what buckets of several blocks still keep apart: every pair of blocks
    large = placed.filter("_blocks > 1")
    if large.limit(1).count():
        lab = labels.select("node", F.col("label"))
        named = large.join(lab, "node", "left").withColumn("label", F.coalesce("label", "node"))
        apart = (named.groupBy("band", "bucket").agg(F.min("label").alias("_lo"), F.max("label").alias("_hi"))
                      .filter("_lo < _hi").select("band", "bucket"))
        pairs = named.join(apart, ["band", "bucket"]).withColumn(
            "_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))).filter("_other != _block")
        pairs = pairs.withColumns({"_p": F.least("_block", "_other"), "_q": F.greatest("_block", "_other")})
        more = _verify(pairs.hint("merge").join(bodies, "node"), ["band", "bucket", "_p", "_q"], width, limit, percent, True)
        more = materialise(more, "near-links")
        labels = components(links.union(more))
    of_class = classes.select(F.col("set_key").alias("_key"), "node").join(labels, "node", "left").select(
        "_key", F.coalesce("label", "node").alias("label"))
    out = sig.select("doc_id", "n_shingles", "set_key").join(of_class, F.col("set_key") == F.col("_key"), "left")
    component = F.when(F.col("doc_id").isNull(), F.lit(None).cast("long")).otherwise(
        F.coalesce("label", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.col("doc_id").eqNullSafe(component).alias("kept"))


SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sh AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
      ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s FROM w),
n AS (SELECT doc_id, len(s) AS n FROM sh),
x AS (SELECT doc_id, unnest(s) AS g FROM sh),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM x a JOIN x b ON a.g = b.g AND a.doc_id <> b.doc_id
      GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
      WHERE 100 * shared >= 85 * (na.n + nb.n - shared)),
r AS (SELECT doc_id AS a, doc_id AS b FROM n UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY 1)
SELECT n.doc_id, n.n AS n_shingles, component_id, n.doc_id = component_id AS kept FROM n JOIN c USING (doc_id)
"""
