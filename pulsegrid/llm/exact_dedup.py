"""Exact duplicates: group by a 128-bit content hash, compare bytes inside groups.

Built-in functions only.  Two texts are equal when they are identical after
every character of ``[\\x20\\x09-\\x0D]`` is deleted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import SPACES, materialise

# (code points, id) as one decimal, which hash aggregation can hold in place: larger for
# more code points, then for a smaller id.  2^64 and 2^63 as decimals.
_RANK = ("CAST(_points AS DECIMAL(12,0)) * CAST(18446744073709551616 AS DECIMAL(20,0)) "
         "+ CAST(9223372036854775808 AS DECIMAL(20,0)) - CAST(doc_id AS DECIMAL(20,0))")
_ID = ("CAST(CAST(9223372036854775808 AS DECIMAL(20,0)) "
       "- _rank % CAST(18446744073709551616 AS DECIMAL(20,0)) AS BIGINT)")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    The rows are grouped by (128-bit hash, normalised bytes): the hash deals
    the rows, the grouping itself compares the bytes, so two texts with one
    hash stay apart.  Map-side combination leaves one copy of a text per task,
    whatever the size of its group.  Of a group the row with the most code
    points in the original text stays, then the smallest id.  The narrow rows
    find their group again by both digests of the text (a join that adaptive
    execution splits when one text holds many rows).

    Null text counts as empty; rows that repeat an id and a text carry equal
    results; a null id ranks last and is never kept unless alone, when its
    keep_id is null and it is kept.  No rows give no rows.  Other columns of
    the input are not read.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = (docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("_text"))
                .select("doc_id", F.translate("_text", SPACES, "").alias("_norm"),
                        F.length("_text").cast("long").alias("_points")))
    groups = (rows.groupBy(F.md5("_norm").alias("_hash"), "_norm")
                  .agg(F.count(F.lit(1)).alias("group_size"),
                       F.max(F.expr(_RANK)).alias("_rank"))
                  .select("_hash", F.sha2("_norm", 256).alias("_sha"), "group_size",
                          F.expr(_ID).alias("keep_id")))
    groups = materialise(groups, "exact-groups")
    narrow = rows.select("doc_id", F.md5("_norm").alias("_hash"), F.sha2("_norm", 256).alias("text_sha256"))
    g = groups.withColumnRenamed("_hash", "_ghash")
    out = narrow.join(g, (F.col("_hash") == F.col("_ghash")) & (F.col("text_sha256") == F.col("_sha")), "inner")
    return out.select("doc_id", "keep_id", "group_size",
                      F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


SQL = r"""
WITH n AS (SELECT doc_id, length(coalesce(text, '')) AS points,
                  regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents),
k AS (SELECT *, first_value(doc_id) OVER (PARTITION BY norm ORDER BY points DESC, doc_id) AS keep_id,
             count(*) OVER (PARTITION BY norm) AS group_size FROM n)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM k
"""
