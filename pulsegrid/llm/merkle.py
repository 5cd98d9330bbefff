"""Merkle manifest of a dataset: levels as concatenated hex strings, hashed by SQL substrings.

The nodes of a group are numbered in order; every aligned block of 512 of them
is one row that keeps each of its levels as one string of 64-character digests.
The parents of a level are the digests of its 512-character substrings, the
siblings of a node the substrings to both sides of it inside its run of eight.
The block roots are the nodes of the next stage, until a group has one block;
the roots of the groups are then nodes of one last group.

A block tells by itself how many levels it needs: block 0 with fewer than 512
nodes is its whole group, any other block lies in a group of 512 and more.  So
no group size is ever joined back, and a group that is done passes the stages
left for larger ones unchanged.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import materialise
from pulsegrid.operators.windows import with_row_index

FAN = 8                 # nodes of a run
STEPS = 3               # levels a block holds below its root
BLOCK = FAN ** STEPS    # nodes of a block
HEX = 64                # characters of a digest
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def leaf_hash(fields) -> Column:
    """SHA-256 of the fields in a row, each ``-`` if null, else byte count, ``:`` and value."""
    parts = []
    for f in fields:
        s = (F.col(f) if isinstance(f, str) else f).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def _parents(level: Column) -> Column:
    """The next level's string: one digest per run of eight."""
    width = FAN * HEX
    return F.array_join(F.transform(
        F.sequence(F.lit(0), F.floor((F.length(level) - 1) / width).cast("int")),
        lambda i: F.sha2(F.substr(level.cast("binary"), i * width + 1, F.lit(width)), 256)), "")


def _blocks(nodes: DataFrame, name: str) -> DataFrame:
    """Nodes ``grp, pos, hash, ...`` to written block rows ``grp, block, members, steps, l0..l2, top``.

    ``members`` holds the nodes in order; ``steps`` is the number of levels
    above them inside the block (0 for a group of one node).
    """
    own = [c for c in nodes.columns if c not in ("grp", "pos")]
    rows = (nodes.groupBy("grp", F.floor(F.col("pos") / BLOCK).cast("long").alias("block"))
                 .agg(F.array_sort(F.collect_list(F.struct("pos", *own))).alias("members")))
    seen = F.when(F.col("block") > 0, BLOCK).otherwise(F.size("members"))
    steps = sum((seen > FAN ** k).cast("int") for k in range(STEPS))
    rows = rows.withColumn("steps", steps).withColumn(
        "l0", F.array_join(F.transform("members", lambda m: m["hash"]), ""))
    for k in range(1, STEPS + 1):
        rows = rows.withColumn(f"l{k}", F.when(F.col("steps") >= k, _parents(F.col(f"l{k - 1}"))))
    top = F.coalesce(*[F.col(f"l{k}") for k in range(STEPS, -1, -1)])
    return materialise(rows.withColumn("top", top).drop(f"l{STEPS}"), name)


def _stages(nodes: DataFrame, name: str) -> list[DataFrame]:
    """Block tables from the nodes up, the last with one block a group."""
    out = []
    while True:
        blocks = _blocks(nodes, f"{name}-{len(out)}")
        out.append(blocks)
        if (blocks.agg(F.max("block")).first()[0] or 0) == 0:
            return out
        nodes = blocks.select("grp", F.col("block").alias("pos"), F.col("top").alias("hash"))


def _segments(i: Column) -> Column:
    """The runs' other digests to the left and right, level by level, for node ``i`` of a block."""
    out = []
    for k in range(STEPS):
        at = F.floor(i / FAN ** k).cast("int")
        level = F.col(f"b{k}")
        left = F.substr(level, F.floor(at / FAN).cast("int") * (FAN * HEX) + 1, (at % FAN) * HEX)
        right = F.substr(level, (at + 1) * HEX + 1, (FAN - 1 - at % FAN) * HEX)
        out.append(F.struct(left.cast("string").alias("left"), right.cast("string").alias("right")))
    return F.slice(F.array(*out), F.lit(1), F.col("steps"))


def _paths(stages: list[DataFrame], above: DataFrame) -> DataFrame:
    """Per node of the lowest stage: the node's columns, ``path`` to the root and the columns of ``above``.

    ``above`` has a row per group: ``grp, path`` (from the group's root up) and more.
    """
    paths = above.withColumn("block", F.lit(0).cast("long"))
    keep = [c for c in above.columns if c not in ("grp", "path")]
    for blocks in reversed(stages):
        binary = [F.coalesce(F.col(f"l{k}"), F.lit("")).cast("binary").alias(f"b{k}") for k in range(STEPS)]
        rows = (blocks.select("grp", "block", "members", "steps", *binary).join(paths, ["grp", "block"])
                      .select("*", F.posexplode("members").alias("_i", "_m")))
        fields = [f for f in blocks.schema["members"].dataType.elementType.names if f != "pos"]
        paths = rows.select("grp", F.col("_m.pos").alias("block"), *keep,
                            F.concat(_segments(F.col("_i")), F.col("path")).alias("path"),
                            *([F.col(f"_m.{f}").alias(f) for f in fields] if blocks is stages[0] else []))
    return paths.withColumnRenamed("block", "pos")


@dataclass
class Manifest:
    """``stages``: block tables of the groups; ``tops``: those over the groups' roots; ``root``: digest or None."""

    stages: list[DataFrame]
    tops: list[DataFrame]
    root: str | None


def manifest(docs: DataFrame, id_col: str = "doc_id", group_col: str = "lang", fields=FIELDS,
             found: Column | None = None) -> Manifest:
    """Build the manifest of ``docs``: leaves ascend by id in each group, groups by name (null first).

    ``found`` is an optional leaf digest of what is there now, kept beside the
    leaf for ``fold``.  A null id comes first, rows with one id follow the order
    of their leaves, so equal rows can't be told apart and need not be.  No
    rows: no blocks and root None.  Other columns are not read.
    """
    grp = F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit(""))
    leaves = docs.select(grp.alias("grp"), F.col(id_col).alias("id"), leaf_hash(fields).alias("hash"),
                         (F.lit(None).cast("string") if found is None else found).alias("found"))
    numbered = with_row_index(leaves, ["id", "hash", "found"], "pos", partition_cols=["grp"])
    stages = _stages(numbered, "merkle")
    roots = with_row_index(stages[-1].select("grp", F.col("top").alias("hash")), ["grp"], "pos")
    tops = _stages(roots.select(F.lit("").alias("grp"), "pos", "hash", F.col("grp").alias("name")), "merkle-top")
    top = tops[-1].select("top").first()
    return Manifest(stages, tops, top[0] if top else None)


def proofs(m: Manifest) -> DataFrame:
    """One row per document: ``id, leaf, found, subroot, path`` (siblings left and right, leaf to root)."""
    spark = m.tops[0].sparkSession
    no_path = F.array().cast("array<struct<left:string,right:string>>")
    top = spark.range(1).select(F.lit("").alias("grp"), no_path.alias("path"))
    groups = _paths(m.tops, top).select(F.col("name").alias("grp"), F.col("hash").alias("subroot"), "path")
    out = _paths(m.stages, materialise(groups, "merkle-groups"))
    return out.select("id", F.col("hash").alias("leaf"), "found", "subroot", "path")


def proof_hash(path: Column) -> Column:
    """SHA-256 of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(path, leaf, lambda h, s: F.sha2(F.concat(s["left"], h, s["right"]), 256))


def tamper_check(docs: DataFrame) -> DataFrame:
    """Every document against the manifest, a third of them (crc32 of the id) with A-Z of the text lower-cased.

    Columns ``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``.
    """
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    lowered = F.translate("text", UPPER, LOWER)
    found = F.when(hit, leaf_hash([*FIELDS[:-1], lowered]))
    m = manifest(docs, found=found)
    root = F.lit(m.root).cast("string")
    return (proofs(m).select(F.col("id").alias("doc_id"), "leaf", "subroot", root.alias("root"),
                             proof_hash(F.col("path")).alias("proof_sha256"),
                             fold(F.coalesce("found", "leaf"), F.col("path")).alias("folded_root"))
            .withColumn("verified", F.col("folded_root") == F.col("root")))


SQL = r"""
WITH RECURSIVE bits AS (
  SELECT i, 0 AS k, i AS v FROM range(256) t(i)
  UNION ALL SELECT i, k + 1, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END FROM bits WHERE k < 8),
crc AS (SELECT list(v ORDER BY i) AS tab FROM bits WHERE k = 8),
docs AS (
  SELECT doc_id, lang, text, concat(
           coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'),
           coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-')) AS head,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ord(c)::BIGINT)),
             lambda h, b: xor(h // 256, tab[(xor(h, b) & 255) + 1])), 4294967295) AS crc
  FROM documents, crc),
lower_az AS (
  SELECT *, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low FROM docs),
leaves AS (
  SELECT doc_id, lang, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         CASE WHEN crc % 3 = 0 THEN sha256(head || coalesce(strlen(low) || ':' || low, '-')) END AS found FROM lower_az),
numbered AS (
  SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         count(*) OVER (PARTITION BY lang) AS n FROM leaves),
lv AS (
  SELECT g, 0 AS k, pos, leaf AS h, n FROM numbered
  UNION ALL
  SELECT g, k + 1, pos // 8, sha256(string_agg(h, '' ORDER BY pos)), (n + 7) // 8 FROM lv WHERE n > 1
  GROUP BY g, k, pos // 8, n),
sub AS (SELECT g, h AS subroot, k AS depth, count(*) OVER () AS groups FROM lv WHERE n = 1),
tv AS (
  SELECT 0 AS k, g AS pos, subroot AS h, groups AS n FROM sub
  UNION ALL
  SELECT k + 1, pos // 8, sha256(string_agg(h, '' ORDER BY pos)), (n + 7) // 8 FROM tv WHERE n > 1
  GROUP BY k, pos // 8, n),
root AS (SELECT h AS root FROM tv WHERE n = 1),
sibs AS (
  SELECT a.g, a.pos, b.k, coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos < a.pos // (8 ** b.k)::BIGINT), '') AS l,
         coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos > a.pos // (8 ** b.k)::BIGINT), '') AS r
  FROM numbered a JOIN lv b ON a.g = b.g AND b.n > 1 AND b.pos // 8 = a.pos // (8 ** (b.k + 1))::BIGINT
  GROUP BY a.g, a.pos, b.k
  UNION ALL
  SELECT a.g, a.pos, s.depth + b.k, coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos < a.g // (8 ** b.k)::BIGINT), ''),
         coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos > a.g // (8 ** b.k)::BIGINT), '')
  FROM numbered a JOIN sub s ON a.g = s.g JOIN tv b ON b.n > 1 AND b.pos // 8 = a.g // (8 ** (b.k + 1))::BIGINT
  GROUP BY a.g, a.pos, s.depth, b.k),
proof AS (SELECT g, pos, sha256(string_agg(l || r, '' ORDER BY k)) AS p, max(k) + 1 AS steps FROM sibs GROUP BY g, pos),
folded AS (
  SELECT g, pos, 0 AS k, coalesce(found, leaf) AS h FROM numbered
  UNION ALL
  SELECT f.g, f.pos, f.k + 1, sha256(s.l || f.h || s.r) FROM folded f JOIN sibs s ON s.g = f.g AND s.pos = f.pos AND s.k = f.k)
SELECT a.doc_id, a.leaf, s.subroot, r.root, coalesce(p.p, sha256('')) AS proof_sha256, f.h AS folded_root,
       f.h = r.root AS verified
FROM numbered a JOIN sub s ON s.g = a.g CROSS JOIN root r LEFT JOIN proof p ON p.g = a.g AND p.pos = a.pos
JOIN folded f ON f.g = a.g AND f.pos = a.pos AND f.k = coalesce(p.steps, 0)
"""
