"""Near duplicates against all pairs; hot groups across blocks; odd sketches."""

import random
import re
from collections import defaultdict

import numpy as np
from llm_rows import EDGE, edge, none  # noqa: F401

from pulsegrid.llm import near_dedup as N


def brute(rows, width, percent):
    sets, ids = {}, []
    for k, r in enumerate(rows):
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), r[1] or ""))
        sets[k] = {tuple(w[i:i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} - {()}
        ids.append(r[0])
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            if ids[i] is None or ids[j] is None or not sets[i]:
                continue
            both = len(sets[i] & sets[j])
            if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    least = defaultdict(list)
    for k in range(len(rows)):
        if ids[k] is not None:
            least[find(k)].append(ids[k])
    return sorted((ids[k] is None, ids[k] or 0, len(sets[k]), None if ids[k] is None else min(least[find(k)]))
                  for k in range(len(rows)))


def got(df):
    rows = df.collect()
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)
    return sorted((r.doc_id is None, r.doc_id or 0, r.n_shingles, r.component_id) for r in rows)


def near_copies(n, words, edits, seed):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(4000)}" for _ in range(words)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randrange(edits + 1)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10 ** 6)}"
        out.append(" ".join(w))
    return out


def test_edge_rows(edge):
    assert got(N.near_groups(edge, 3, 85, 24, 5)) == brute(EDGE, 3, 85)


def test_empty(none):
    assert N.near_groups(none).count() == 0


def test_all_pairs(spark):
    texts = [t for s in range(8) for t in near_copies(25, 60 + 20 * s, 6, s)]
    rows = [(7 * i % 1009, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for width, percent, bands, per in ((3, 85, 24, 5), (5, 80, 30, 4)):
        assert got(N.near_groups(df, width, percent, bands, per)) == brute(rows, width, percent)


def test_hot_group_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK", 16)
    texts = near_copies(300, 80, 8, 3)
    rows = [(i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert got(N.near_groups(df, 3, 85, 24, 5)) == brute(rows, 3, 85)


def test_sketch_never_rules_out_a_link():
    family, rng = N._hash_family(120), np.random.default_rng(1)
    limit = N.most_bits(120, 0.85)
    seen = []
    for _ in range(300):
        a = rng.integers(0, 2 ** 63, 400, dtype=np.uint64)
        b = np.concatenate([a[32:], rng.integers(0, 2 ** 63, 32, dtype=np.uint64)])    # J = 368 / 432
        x, y = (N.odd_sketch(N.minhash(np.unique(s), family)) for s in (a, b))
        seen.append(int(np.bitwise_count(x ^ y).sum()))
    assert max(seen) <= limit
    far = rng.integers(0, 2 ** 63, 400, dtype=np.uint64)
    assert np.bitwise_count(N.odd_sketch(N.minhash(far, family)) ^ x).sum() > limit


def test_components_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 99)], "a long, b long")
    rows = dict(tuple(r) for r in N.components(edges).collect())
    assert rows == {**{i: 0 for i in range(41)}, 99: 99, 100: 99}


def test_exploded_rows_are_never_broadcast(spark, monkeypatch):
    """Places of classes in buckets come from an explode, which Spark sizes like its input: small tables too
    must join them without a broadcast."""
    plans, write = {}, N.materialise

    def seen(df, name):
        plans.setdefault(name, df._jdf.queryExecution().executedPlan().toString())
        return write(df, name)
    monkeypatch.setattr(N, "materialise", seen)
    df = spark.createDataFrame(list(enumerate(near_copies(40, 60, 4, 1))), "doc_id long, text string")
    N.near_groups(df, 3, 85, 24, 5).collect()
    for name in ("near-buckets", "near-links"):
        assert "SortMergeJoin" in plans[name] and "Broadcast" not in plans[name]
