"""Sharding by a K-d tree: weighted median cuts along the widest metadata dimension.

Built-in functions only.  The tree is grown level by level; all nodes of a
level are cut together by weighted histograms, so a level costs a few scans of
a narrow table, and only histogram rows (bounded by nodes x bins) reach the
driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import materialise

BITS = 30            # bits of a scaled dimension; as many hash bits below it break ties
BINS = 4096          # histogram bins per node and pass
TOLERANCE = 2e-4     # a cut may be off by this share of its node


def _dims(metadata: list[str], g: DataFrame, scales: dict) -> list:
    """Each dimension as a long: scaled value above, hash below (a total order of groups)."""
    out = []
    for c in metadata:
        lo, hi = scales[c]
        span = max(hi - lo, 1)
        v = F.floor((F.coalesce(F.col(c), F.lit(lo)) - F.lit(lo)) / F.lit(float(span)) * F.lit((1 << BITS) - 1.0))
        out.append(F.shiftleft(v.cast("long"), BITS) + F.pmod(F.xxhash64(F.lit(c), "_h1", "_h2"), F.lit(1 << BITS)))
    return out


def _cut_level(g: DataFrame, nodes: dict, n_dims: int) -> dict:
    """For each node with more than one leaf: (dimension, cut); rows with value <= cut go left."""
    stats = g.groupBy("_node").agg(F.sum("_w").alias("w"), *[f(F.element_at("_d", i + 1)).alias(f"{n}{i}")
                                   for i in range(n_dims) for f, n in ((F.min, "lo"), (F.max, "hi"))]).collect()
    open_, done = {}, {}
    for r in stats:
        leaves = nodes.get(r["_node"], 1)
        if leaves < 2:
            continue
        dim = max(range(n_dims), key=lambda i: (r[f"hi{i}"] - r[f"lo{i}"], -i))
        want = r["w"] * (leaves // 2) / leaves
        open_[r["_node"]] = {"dim": dim, "lo": r[f"lo{dim}"], "hi": r[f"hi{dim}"], "below": 0, "want": want,
                             "tol": r["w"] * TOLERANCE}
    while open_:
        # equal-width bins between lo and hi of each open node, by lookup arrays of the level
        size = max(open_) + 1
        at = lambda key, kind: F.get(F.lit([open_.get(i, {}).get(key, 0) for i in range(size)])
                                     .cast(f"array<{kind}>"), F.col("_node").cast("int"))
        width = {n: max(1, -(-(o["hi"] - o["lo"] + 1) // BINS)) for n, o in open_.items()}
        for n, o in open_.items():
            o["width"] = width[n]
        v = F.get("_d", at("dim", "int"))
        rows = (g.filter(F.col("_node").isin(list(open_)))
                 .select("_node", v.alias("v"), "_w", at("lo", "bigint").alias("lo"), at("hi", "bigint").alias("hi"),
                         at("width", "bigint").alias("width"))
                 .filter((F.col("v") >= F.col("lo")) & (F.col("v") <= F.col("hi")))
                 .groupBy("_node", F.expr("(v - lo) div width").alias("bin")).agg(F.sum("_w").alias("w")).collect())
        hist: dict = {}
        for r in rows:
            hist.setdefault(r["_node"], []).append((r["bin"], r["w"]))
        for n in list(open_):
            o, below, best = open_[n], open_[n]["below"], None
            for b, w in sorted(hist.get(n, [])):
                if below + w >= o["want"]:
                    best = (b, below, w)
                    break
                below += w
            if best is None:            # all weight lies below: everything goes left
                done[n] = (o["dim"], o["hi"])
                del open_[n]
                continue
            b, below, w = best
            start, end = o["lo"] + b * o["width"], min(o["hi"], o["lo"] + (b + 1) * o["width"] - 1)
            if o["width"] == 1 or min(o["want"] - below, below + w - o["want"]) <= o["tol"]:
                left = o["want"] - below <= below + w - o["want"] and below > 0
                done[n] = (o["dim"], start - 1 if left else end)
                del open_[n]
            else:
                o.update(lo=start, hi=end, below=below)
    return done


def grow_tree(g: DataFrame, n_shards: int, n_dims: int) -> tuple[list[dict], dict]:
    """Levels of cuts {node: (dim, cut)} and the first shard of each leaf node.

    ``g`` has ``_d`` (array of longs) and ``_w``; children of node i are 2i and 2i+1 of the next level.
    """
    levels, nodes, first = [], {0: n_shards}, {0: 0}
    while any(n > 1 for n in nodes.values()):
        levels.append(_cut_level(g.withColumn("_node", node_of(levels)), nodes, n_dims))
        nxt, nfirst = {}, {}
        for n, leaves in nodes.items():
            if leaves < 2:
                nxt[2 * n], nfirst[2 * n] = leaves, first[n]
            else:
                nxt[2 * n], nxt[2 * n + 1] = leaves // 2, leaves - leaves // 2
                nfirst[2 * n], nfirst[2 * n + 1] = first[n], first[n] + leaves // 2
        nodes, first = nxt, nfirst
    return levels, first


def node_of(levels: list[dict], d="_d"):
    """The node a point reaches: one fold over the levels, cuts looked up in literal arrays."""
    if not levels:
        return F.lit(0).cast("long")
    size = lambda k: 1 << k
    dims = F.lit([[cuts.get(i, (0, 0))[0] for i in range(size(k))] for k, cuts in enumerate(levels)])
    ends = F.lit([[cuts[i][1] if i in cuts else 1 << 62 for i in range(size(k))] for k, cuts in enumerate(levels)])
    dims, ends = dims.cast("array<array<int>>"), ends.cast("array<array<bigint>>")

    def child(node, k):
        pos = node.cast("int")
        right = F.get(F.col(d), F.get(F.get(dims, k), pos)) > F.get(F.get(ends, k), pos)
        return node * 2 + F.when(right, F.lit(1).cast("long")).otherwise(F.lit(0).cast("long"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(len(levels) - 1)), F.lit(0).cast("long"), child)


def kd_shards(docs: DataFrame, n_shards: int | None = None, target_bytes: int | None = None,
              id_col: str = "doc_id", text_col: str = "text", metadata: tuple[str, ...] = ("source", "lang")) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` of every row, equal texts in one shard.

    The points are groups of equal texts (128-bit hash), weighted by their
    bytes plus one per row; the dimensions are the smallest id, the length and
    codes of the metadata columns that exist.  Leaves are cut until they reach
    ``target_bytes`` (or until there are ``n_shards``).  A slot counts the
    rows of its shard from 0 in the order of (doc_id, crc, size).  Null text
    has no bytes, null metadata the lowest code; a null id sorts first;
    repeated rows keep their own slots; an empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    names = [c for c in metadata if c in docs.columns]
    code = [F.crc32(F.coalesce(F.col(c).cast("string"), F.lit("")).cast("binary")).alias(f"_m{i}")
            for i, c in enumerate(names)]
    rows = materialise(docs.select(
        F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
        F.xxhash64(F.col(text_col)).alias("_h1"), F.xxhash64(F.lit("second"), F.col(text_col)).alias("_h2"),
        F.length(text).cast("long").alias("_len"), *code), "kd-rows")
    axes = ["_id", "_len", *[f"_m{i}" for i in range(len(names))]]
    groups = materialise(rows.groupBy("_h1", "_h2").agg(
        F.sum("size").alias("_w"), F.min("doc_id").alias("_id"),
        *[F.min(a).alias(a) for a in axes[1:]]), "kd-groups")
    r = groups.agg(F.sum("_w").alias("w"), *[f(a).alias(f"{a}_{n}") for a in axes
                                             for f, n in ((F.min, "lo"), (F.max, "hi"))]).first()
    total = r["w"] or 0
    if n_shards is None:
        n_shards = max(1, -(-total // (target_bytes or 1 << 28)))
    scales = {a: (r[f"{a}_lo"] or 0, r[f"{a}_hi"] or 0) for a in axes}
    points = groups.select("_h1", "_h2", "_w", F.array(*_dims(axes, groups, scales)).alias("_d"))
    levels, first = grow_tree(points, n_shards, len(axes))
    shards = F.lit([first.get(i, 0) for i in range(1 << len(levels))]).cast("array<int>")
    shard = F.get(shards, node_of(levels).cast("int"))
    placed = points.select("_h1", "_h2", shard.alias("shard"))
    out = rows.join(placed, ["_h1", "_h2"]).select("doc_id", "size", "text_crc32", "shard")
    return with_slots(out)


def with_slots(rows: DataFrame) -> DataFrame:
    """Gapless ``slot`` per shard without a window over whole shards.

    Rows are range-partitioned and sorted, numbered within their partition,
    written once; each (partition, shard) run then gets the count before it.
    The run table has at most partitions + shards rows.
    """
    keys = ["shard", "doc_id", "text_crc32", "size"]
    spark = rows.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    t = materialise(rows.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
                        .withColumn("_at", F.monotonically_increasing_id()), "kd-slots")
    part = F.shiftright("_at", 33)
    runs = t.groupBy("shard", part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    runs = runs.select(F.col("shard").alias("_s"), "_part", "_first", F.expr(
        "coalesce(sum(_n) OVER (PARTITION BY shard ORDER BY _part "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)").alias("_before"))
    out = t.join(F.broadcast(runs), (F.col("shard") == F.col("_s")) & (part == F.col("_part")))
    return out.select("doc_id", "size", "text_crc32", "shard",
                      (F.col("_before") + F.col("_at") - F.col("_first")).cast("long").alias("slot"))
