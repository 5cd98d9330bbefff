"""Conversation prefix trie with subtree totals by parallel tree contraction.

A node is a distinct sequence of first turns.  Its key is the exclusive-or of
128-bit digests of (position, turn), so the keys of all prefixes are running
aggregates: a conversation of any length is cut into blocks of positions, and
no conversation has to meet in one task.

Subtree totals come from contraction in join rounds: every round rakes all
leaves (their totals go to their parents, combined before the shuffle) and
compresses unary chains (a node with one child left is spliced out when its own
coin shows 1 and its parent's 0, so no two neighbours go at once).  The rounds
needed grow with the logarithm of the nodes, not with the depth.  Raked nodes
know their totals at once; spliced ones are re-expanded from the last round to
the first: a spliced node's total is its child's plus what lay between.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.llm.common import materialise
from pulsegrid.operators.windows import with_row_index

FAMILY = 20      # conversations c - c % FAMILY lend their first turns
POSITIONS = 256  # positions of a block of running keys
ID_SPAN = 1024   # conversation ids of a piece of an end list
WORD = r"[^\x20\x09-\x0D]+"
TOTALS = ("n_leaves", "saved_tokens")


def numbered_turns(convs: DataFrame) -> DataFrame:
    """``conv_id, pos, turn_hash, words``: turns from 1 by turn (null first), ties by the digest of role and text."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = convs.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"),
        F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256).alias("turn_hash"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))
    return (with_row_index(rows, ["turn", "turn_hash"], "_i", partition_cols=["conv_id"])
            .select("conv_id", (F.col("_i") + 1).alias("pos"), "turn_hash", "words"))


def _block(pos: str) -> Column:
    return F.floor((F.col(pos) - 1) / POSITIONS).cast("long")


def rebuild(turns: DataFrame, family: int = FAMILY) -> tuple[DataFrame, DataFrame]:
    """(rebuilt turns with ``last``, ids with their rebuilt ``n``).

    Every id starts with the first h turns of the first id of its family, h =
    crc32(id) % 4.  Facts about an id reach its turns by (id, block of
    positions), so a long conversation is spread over many groups.
    """
    spans = turns.groupBy("conv_id", _block("pos").alias("_block")).agg(F.max("pos").alias("_top"))
    ids = spans.groupBy("conv_id").agg(F.max("_top").alias("_own")).select(
        "conv_id", "_own", (F.col("conv_id") - F.col("conv_id") % family).alias("_lender"),
        (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4).alias("_h"))
    size = ids.select(F.col("conv_id").alias("_lender"), F.col("_own").alias("_has"))
    lent = F.least("_h", F.coalesce("_has", F.lit(0).cast("long")))
    ids = materialise(ids.join(size, "_lender", "left").withColumn("_lent", lent).withColumn(
        "n", F.col("_lent") + F.greatest(F.col("_own") - F.col("_h"), F.lit(0))), "trie-ids")
    heads = turns.filter("pos <= 3").withColumnRenamed("conv_id", "_lender")
    first = ids.join(heads, "_lender").filter("pos <= _h").select(
        "conv_id", "pos", "turn_hash", "words", (F.col("pos") == F.col("n")).alias("last"))
    facts = spans.select("conv_id", "_block").join(ids, "conv_id")
    own = turns.withColumn("_block", _block("pos")).join(facts, ["conv_id", "_block"]).filter("pos > _h")
    moved = F.col("pos") - F.col("_h") + F.col("_lent")
    rest = own.select("conv_id", moved.alias("pos"), "turn_hash", "words", (moved == F.col("n")).alias("last"))
    return first.unionByName(rest), ids.select("conv_id", "n")


def _running_keys(rows: DataFrame, group: str, pos: str, words: list[str]) -> DataFrame:
    """Columns ``words`` replaced by their running exclusive-or by ``pos`` (gapless from 1) within ``group``."""
    block = _block(pos)
    w = Window.partitionBy(group, "_block").orderBy(pos).rowsBetween(Window.unboundedPreceding, 0)
    own = [c for c in rows.columns if c not in words]
    out = rows.withColumn("_block", block).select(*own, "_block", *[F.bit_xor(c).over(w).alias(c) for c in words])
    blocks = rows.groupBy(group, (block + 1).alias("_b")).agg(*[F.bit_xor(c).alias(c) for c in words])
    blocks = materialise(blocks, "trie-blocks")
    if (blocks.agg(F.max("_b")).first()[0] or 1) == 1:
        return out.drop("_block")
    # the keys of all earlier blocks: running keys of the blocks, one block later
    before = _running_keys(blocks, group, "_b", words).select(
        F.col(group).alias("_g"), F.col("_b").alias("_before"), *[F.col(c).alias(f"_{c}") for c in words])
    joined = out.join(before, (F.col(group) == F.col("_g")) & (F.col("_block") == F.col("_before")), "left")
    return joined.select(*own, *[F.col(c).bitwiseXOR(F.coalesce(f"_{c}", F.lit(0).cast("long"))).alias(c) for c in words])


def _hex(a: str, b: str) -> Column:
    return F.concat(*[F.lpad(F.hex(c), 16, "0") for c in (a, b)])


ROOT = "0" * 32   # key of the empty sequence


def prefixes(turns: DataFrame, ids: DataFrame) -> DataFrame:
    """One row per conversation and depth: ``conv_id, depth, node, parent, words, last`` (last: the conversation ends)."""
    digest = F.sha2(F.concat(F.col("pos").cast("string"), F.lit(":"), "turn_hash"), 256)
    halves = [F.conv(F.substring("_d", 1 + 16 * k, 16), 16, -10).cast("long").alias(f"_k{k}") for k in range(2)]
    rows = turns.select("conv_id", "pos", "words", "last", digest.alias("_d")).select(
        "conv_id", "pos", "words", "last", *halves, *[h.alias(f"_o{k}") for k, h in enumerate(halves)])
    keyed = _running_keys(rows, "conv_id", "pos", ["_k0", "_k1"])
    for k in range(2):   # without the last turn it is the parent's key
        keyed = keyed.withColumn(f"_o{k}", F.col(f"_o{k}").bitwiseXOR(F.col(f"_k{k}")))
    nodes = keyed.select("conv_id", F.col("pos").alias("depth"), _hex("_k0", "_k1").alias("node"),
                         _hex("_o0", "_o1").alias("parent"), "words", "last")
    root = ids.select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit(ROOT).alias("node"),
                      F.lit(None).cast("string").alias("parent"), F.lit(0).cast("long").alias("words"),
                      (F.col("n") == 0).alias("last"))
    return materialise(nodes.unionByName(root), "trie-prefixes")


def _hash_lists(batches):
    """Sorted (node, piece) rows to (node, SHA-256 of the pieces joined by commas)."""
    schema = pa.schema([("node", pa.string()), ("ends_sha256", pa.string())])
    node, digest = None, None
    for b in batches:
        names, digests = [], []
        for key, piece in zip(b.column("node").to_pylist(), b.column("piece").to_pylist(), strict=True):
            if key != node:
                if node is not None:
                    names.append(node)
                    digests.append(digest.hexdigest())
                node, digest = key, hashlib.sha256(piece.encode())
            else:
                digest.update(b"," + piece.encode())
        if names:
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(digests, pa.string())], schema=schema)
    if node is not None:
        yield pa.RecordBatch.from_arrays([pa.array([node]), pa.array([digest.hexdigest()])], schema=schema)


def end_lists(rows: DataFrame) -> DataFrame:
    """``node, ends_sha256`` of the nodes where conversations end.

    Ids meet in pieces of one span of ids; a list's digest then streams over
    its pieces in order, so memory is bounded by a piece, however long the list.
    """
    span = F.floor(F.col("conv_id") / ID_SPAN).cast("long")
    pieces = (rows.filter("last").groupBy("node", span.alias("span"))
                  .agg(F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")
                       .alias("piece")))
    return (pieces.repartition("node").sortWithinPartitions("node", "span").select("node", "piece")
                  .mapInArrow(_hash_lists, "node string, ends_sha256 string"))


def _coin(key: Column, turn: int) -> Column:
    return F.xxhash64(key, F.lit(turn)).bitwiseAND(F.lit(1).cast("long"))


def contract(nodes: DataFrame, values: tuple[str, ...] = TOTALS) -> DataFrame:
    """``node`` and the sums of ``values`` over its subtree, for a tree ``node, parent, kids, *values``.

    ``kids`` is the number of children; the root has a null parent.  Values are
    longs.  ``_e_*`` holds what lies on the edge to the parent after splices.
    """
    zero = F.lit(0).cast("long")
    alive = nodes.select("node", "parent", F.col("kids").cast("long").alias("kids"), *values,
                         *[zero.alias(f"_e_{v}") for v in values])
    known, spliced, turn = [], [], 0
    while True:
        alive = materialise(alive, f"trie-alive-{turn}")
        known.append(alive.filter("kids = 0").select("node", *values))
        if alive.filter("kids > 0").isEmpty():
            break
        # rake: leaves give their totals to their parents; what stays alone below a parent is noted
        inner = F.col("kids") > 0
        below = alive.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("_p")).agg(
            F.count(F.when(inner, 1)).alias("_rest"), F.max(F.when(inner, F.col("node"))).alias("_only"),
            *[F.sum(F.when(~inner, F.col(v) + F.col(f"_e_{v}")).otherwise(zero)).alias(f"_g_{v}") for v in values],
            *[F.sum(F.when(inner, F.col(f"_e_{v}")).otherwise(zero)).alias(f"_u_{v}") for v in values])
        raked = alive.filter(inner).join(below, F.col("node") == F.col("_p")).select(
            "node", "parent", F.col("_rest").alias("kids"), *[(F.col(v) + F.col(f"_g_{v}")).alias(v) for v in values],
            *[f"_e_{v}" for v in values], "_only", *[f"_u_{v}" for v in values],
            (F.col("parent").isNotNull() & (F.col("_rest") == 1) & (_coin(F.col("node"), turn) == 1)
             & ((_coin(F.col("parent"), turn) == 0) | (F.col("parent") == ROOT))).alias("_gone"))
        raked = materialise(raked, f"trie-raked-{turn}")
        # compress: the only child of a spliced node takes its parent and its weight on the edge
        gone = raked.filter("_gone")
        spliced.append(gone.select("node", F.col("_only").alias("_child"),
                                   *[(F.col(v) + F.col(f"_u_{v}")).alias(f"_w_{v}") for v in values]))
        above = gone.select(F.col("_only").alias("_child"), F.col("parent").alias("_up"),
                            *[(F.col(v) + F.col(f"_e_{v}")).alias(f"_w_{v}") for v in values])
        alive = raked.filter("NOT _gone").join(above, F.col("node") == F.col("_child"), "left").select(
            "node", F.coalesce("_up", "parent").alias("parent"), "kids", *values,
            *[(F.col(f"_e_{v}") + F.coalesce(f"_w_{v}", zero)).alias(f"_e_{v}") for v in values])
        turn += 1
    # known[t] were raked in round t; spliced[t] left in round t, their children later
    later = known[turn]
    for t in reversed(range(turn)):
        totals = later.select(F.col("node").alias("_child"), *[F.col(v).alias(f"_t_{v}") for v in values])
        back = spliced[t].join(totals, "_child").select(
            "node", *[(F.col(f"_t_{v}") + F.col(f"_w_{v}")).alias(v) for v in values])
        later = materialise(later.unionByName(back).unionByName(known[t]), f"trie-totals-{t}")
    return later


def prefix_trie(convs: DataFrame, family: int = FAMILY) -> DataFrame:
    """One row per node: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``
    and its key ``node``.

    Rows without a conv_id belong to no conversation.  Null role and text are
    empty; null turns come first, equal turns by the digest of role and text;
    repeated rows are repeated turns.  No conversations, no nodes.  Other
    columns are not read.
    """
    rows = prefixes(*rebuild(materialise(numbered_turns(convs), "trie-turns"), family))
    found = (rows.groupBy("node").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"),
                                      F.first("depth").alias("depth"), F.first("parent").alias("parent"),
                                      F.first("words").alias("words")))
    found = materialise(found, "trie-nodes")
    kids = found.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("_p")).agg(F.count(F.lit(1)).alias("_k"))
    ends = end_lists(rows).withColumnRenamed("node", "_e")
    empty = hashlib.sha256(b"").hexdigest()
    nodes = (found.join(kids, F.col("node") == F.col("_p"), "left").join(ends, F.col("node") == F.col("_e"), "left")
                  .select("node", "parent", "conv_id", "depth", "n_convs", F.coalesce("_k", F.lit(0)).alias("n_children"),
                          ((F.col("n_convs") - 1) * F.col("words")).alias("saved"),
                          F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256")))
    nodes = materialise(nodes, "trie-attributes")
    totals = contract(nodes.select("node", "parent", F.col("n_children").alias("kids"),
                                   F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("n_leaves"),
                                   F.col("saved").alias("saved_tokens")))
    # children of one node may be a third of all rows: adaptive execution splits them
    upper = nodes.filter("n_children > 0").select(F.col("node").alias("_p"), F.col("conv_id").alias("parent_conv_id"))
    return (nodes.join(totals, "node").join(upper, F.col("parent") == F.col("_p"), "left")
                 .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                         "ends_sha256", "node"))


SQL = r"""
WITH RECURSIVE bits AS (
  SELECT i, 0 AS k, i AS v FROM range(256) t(i)
  UNION ALL SELECT i, k + 1, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END FROM bits WHERE k < 8),
crc AS (SELECT list(v ORDER BY i) AS tab FROM bits WHERE k = 8),
orig AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
                            sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (
  SELECT conv_id, conv_id - conv_id % 20 AS lender,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ord(c)::BIGINT)),
             lambda h, b: xor(h // 256, tab[(xor(h, b) & 255) + 1])), 4294967295) % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM orig), crc),
rebuilt AS (
  SELECT i.conv_id, 0 AS part, o.pos, o.role, o.text FROM ids i JOIN orig o ON o.conv_id = i.lender AND o.pos <= i.h
  UNION ALL SELECT i.conv_id, 1, o.pos, o.role, o.text FROM ids i JOIN orig o ON o.conv_id = i.conv_id AND o.pos > i.h),
turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY part, pos) AS depth, text,
         strlen(role) || ':' || role || strlen(text) || ':' || text AS item FROM rebuilt),
pre AS (
  SELECT conv_id, depth, text, string_agg(item, '') OVER (PARTITION BY conv_id ORDER BY depth) AS node,
         count(*) OVER (PARTITION BY conv_id) AS n FROM turns
  UNION ALL SELECT i.conv_id, 0, '', '', (SELECT count(*) FROM turns t WHERE t.conv_id = i.conv_id) FROM ids i),
steps AS (
  SELECT p.*, lag(node) OVER (PARTITION BY conv_id ORDER BY depth) AS parent FROM pre p),
nodes AS (
  SELECT node, any_value(depth) AS depth, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs,
         (count(*) - 1) * len(regexp_extract_all(any_value(text), '[^\x20\x09-\x0D]+')) AS saved,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (depth = n), '')) AS ends_sha256
  FROM steps GROUP BY node),
kids AS (SELECT parent, count(*) AS k FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
flags AS (SELECT n.*, coalesce(k.k, 0) AS n_children FROM nodes n LEFT JOIN kids k ON k.parent = n.node),
pairs AS (SELECT DISTINCT a.node AS top, b.node AS low FROM steps a JOIN steps b ON a.conv_id = b.conv_id AND a.depth <= b.depth),
sums AS (
  SELECT p.top, count(*) FILTER (f.n_children = 0) AS n_leaves, sum(f.saved) AS saved
  FROM pairs p JOIN flags f ON f.node = p.low GROUP BY p.top)
SELECT f.conv_id, f.depth, u.conv_id AS parent_conv_id, f.n_convs, f.n_children, s.n_leaves,
       CAST(s.saved AS BIGINT) AS saved_tokens, f.ends_sha256
FROM flags f JOIN sums s ON s.top = f.node LEFT JOIN flags u ON u.node = f.parent
"""
