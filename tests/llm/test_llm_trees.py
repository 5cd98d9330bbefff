"""Merkle manifest, conversation trie, byte-level BPE."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
from llm_rows import DOCS, EDGE, doc, edge, none  # noqa: F401

from pulsegrid.llm import byte_bpe as B
from pulsegrid.llm import merkle as M
from pulsegrid.llm import prefix_trie as P


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def brute_leaf(r, text):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r[0], r[3], r[2], r[4], text)))


def climb(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i:i + 8])) for i in range(0, len(levels[-1]), 8)])
    return levels


def siblings(levels, i):
    for lv in levels[:-1]:
        a = i // 8 * 8
        yield "".join(lv[a:i]), "".join(lv[i + 1:a + 8])
        i //= 8


def brute_merkle(rows):
    groups = defaultdict(list)
    for r in rows:
        hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
        low = None if r[1] is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in r[1])
        groups[r[2]].append((r[0], brute_leaf(r, r[1]), brute_leaf(r, low) if hit else None))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        groups[g].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[g] = climb([x[1] for x in groups[g]])
    top = climb([trees[g][-1][0] for g in names])
    out = Counter()
    for k, g in enumerate(names):
        for i, (d, leaf, found) in enumerate(groups[g]):
            path = [*siblings(trees[g], i), *siblings(top, k)]
            h = found or leaf
            for a, b in path:
                h = sha(a + h + b)
            out[(d, leaf, trees[g][-1][0], top[-1][0], sha("".join(a + b for a, b in path)), h, h == top[-1][0])] += 1
    return out


def test_merkle_edge_rows(spark, edge):
    got = M.tamper_check(edge).collect()
    assert Counter(tuple(r) for r in got) == brute_merkle(EDGE)


@pytest.mark.parametrize("sizes", [[1], [8], [9], [1, 64, 65, 512], [513, 1100, *[2] * 9]])
def test_merkle_shapes(spark, sizes):
    rows, n = [], 0
    for g, size in enumerate(sizes):
        for _ in range(size):
            rows.append(doc(n * 7 % 10007, f"Text {n}", None if g == 0 else f"l{g}"))
            n += 1
    got = M.tamper_check(spark.createDataFrame(rows, DOCS)).collect()
    assert Counter(tuple(r) for r in got) == brute_merkle(rows)
    assert {r.verified for r in got} == ({True, False} if n > 8 else {r.verified for r in got})


def test_merkle_empty(spark, none):
    assert M.tamper_check(none).count() == 0
    assert M.manifest(none).root is None


CONVS = "conv_id long, turn long, role string, text string, node string, depth long, words string"


def conv_rows(convs):
    return [(c, t, r, x, "?", 0, "?") for c, turns in convs.items() for t, (r, x) in enumerate(turns)]


def brute_trie(rows):
    own = defaultdict(list)
    for r in rows:
        if r[0] is not None:
            own[r[0]].append(r)
    for c, g in own.items():
        g.sort(key=lambda r: (r[1] is not None, r[1] or 0, sha(f"{len((r[2] or '').encode())}:{r[2] or ''}{r[3] or ''}")))
        own[c] = [(r[2] or "", r[3] or "") for r in g]
    full = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        full[c] = tuple(own.get(c - int(c - 20 * int(c / 20)), [])[:h] + own[c][h:])
    members = defaultdict(list)
    for c, turns in full.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    leaves, saved, kids = Counter(), Counter(), Counter(k[:-1] for k in members if k)
    for k, m in members.items():
        words = len(k[-1][1].encode().split()) if k else 0   # ASCII white space alone
        for d in range(len(k) + 1):
            leaves[k[:d]] += kids[k] == 0
            saved[k[:d]] += (len(m) - 1) * words
    return Counter((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), kids[k], leaves[k], saved[k],
                    sha(",".join(str(c) for c in sorted(m) if len(full[c]) == len(k)))) for k, m in members.items())


def same_trie(spark, rows):
    got = P.prefix_trie(spark.createDataFrame(rows, CONVS)).drop("node").collect()
    assert Counter(tuple(r) for r in got) == brute_trie(rows)
    return got


def test_trie_edge_rows(spark):
    u, a = "user", "assistant"
    convs = {20: [(u, "hi there"), (a, "hello you"), (u, "x")], 21: [(u, "hi there"), (a, "hello you"), (u, "y z")],
             23: [(u, "")], 25: [(None, None)], 27: [("", "")], -1: [(u, "a b"), (a, "c")], -25: [(u, "a b")],
             40: [(u, "one\x1ctwo\x0bthree")], 45: [(u, "w " * 40_000)], 61: [(u, "lost")], 62: [(u, "lost")]}
    rows = conv_rows(convs)
    rows += [(None, 0, u, "no id", "?", 0, "?"), (20, None, u, "null turn", "?", 0, "?"),
             (24, 0, u, "twice", "?", 0, "?"), (24, 0, u, "twice", "?", 0, "?"), (24, 0, a, "tie", "?", 0, "?")]
    same_trie(spark, rows)


def test_trie_copies_and_long_chains(spark, monkeypatch):
    monkeypatch.setattr(P, "POSITIONS", 4)
    monkeypatch.setattr(P, "ID_SPAN", 16)
    rng = random.Random(5)
    long = [("user", f"turn {i} of many") for i in range(40)]
    convs = {c: long[:20] for c in range(100, 240, 2)}                           # one conversation, often
    convs |= {1000: long, 1001: [*long[:15], ("user", "off")], 1002: long[:2]}   # long chains with branches
    convs |= {c: [("user", rng.choice("ab")) for _ in range(rng.randrange(5))] or [("user", "z")] for c in range(300, 340)}
    got = same_trie(spark, conv_rows(convs))
    assert max(r.depth for r in got) == 40


def test_trie_empty(spark):
    assert P.prefix_trie(spark.createDataFrame([], CONVS)).count() == 0


def test_contraction_keeps_every_total(spark):
    """A random tree with a chain, against sums from the leaves up."""
    rng = random.Random(1)
    parent = {0: None} | {i: rng.randrange(max(0, i - 3), i) for i in range(1, 60)} | {i: i - 1 for i in range(60, 90)}
    own = {i: rng.randrange(-5, 50) for i in parent}
    total, kids = dict(own), Counter(p for p in parent.values() if p is not None)
    for i in sorted(parent, reverse=True):
        if parent[i] is not None:
            total[parent[i]] += total[i]
    name = lambda i: P.ROOT if i == 0 else f"n{i}"
    rows = [(name(i), None if p is None else name(p), kids[i], own[i]) for i, p in parent.items()]
    df = spark.createDataFrame(rows, "node string, parent string, kids long, v long")
    assert {r.node: r.v for r in P.contract(df, ("v",)).collect()} == {name(i): t for i, t in total.items()}


def test_sql_twins_on_edge_rows(spark, edge):
    con = duckdb.connect()
    documents = edge.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"]).toArrow()   # read by the SQL text
    con.register("documents", documents)
    want = Counter(con.sql(M.SQL).select("doc_id, leaf, subroot, root, proof_sha256, folded_root, verified").fetchall())
    got = M.tamper_check(edge.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"])).collect()
    assert Counter(tuple(r) for r in got) == want


def own_encoding():
    import public_tokenizers
    import tiktoken
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=B.read_ranks(), special_tokens={})


def test_bpe_edge_rows(spark, edge, monkeypatch):
    enc = own_encoding()
    odd = [doc(100 + i, t) for i, t in enumerate([
        "a b \x85\x1c 　 x", "\U0001f9d1‍\U0001f680 ำ่ ａ１ ²³ Ⅷ", "word\n\n  \tnext  ", " ", "  a", "don't I'LL we'd",
        "͸\U0001fae8\U00031350 ￿", "x" * 3000 + " " * 3000 + "y", "<|endoftext|> plain", "a\x00b"])]
    rows = EDGE + odd + [doc(7, "repeated id"), doc(7, "repeated id")]
    df = spark.createDataFrame(rows, DOCS).repartition(3)
    encoded = B.encode(df.withColumn("ids", df.score))
    assert set(encoded.columns) == set(df.columns) - {"text"} | {"ids"}
    got = Counter((r.doc_id, r.source, tuple(r.ids)) for r in encoded.collect())
    want = Counter((r[0], r[3], tuple(enc.encode_ordinary(r[1] or ""))) for r in rows)
    assert got == want
    trip = Counter(tuple(r) for r in B.round_trip(df).collect())
    assert trip == Counter((r[0], len(i), sha(",".join(map(str, i))), sha(r[1] or "")) for r in rows
                           for i in [enc.encode_ordinary(r[1] or "")])


def test_bpe_small_blocks_and_slices(spark, monkeypatch):
    enc = own_encoding()
    rng = random.Random(3)
    chars = "ab 1.\n\té　 '"
    texts = ["".join(rng.choice(chars) for _ in range(rng.randrange(200))) for _ in range(300)]
    assert all([w for s in B.slices(t, 20) for w in B._splitter(B_PATTERN)(s)] == B._splitter(B_PATTERN)(t) for t in texts)
    monkeypatch.setattr(B, "BLOCK_ITEMS", 50)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: list(r.ids) for r in B.encode(df).collect()}
    assert got == {i: enc.encode_ordinary(t) for i, t in enumerate(texts)}


def test_bpe_empty_and_unknown_ids(spark, none):
    assert B.round_trip(none).count() == 0
    df = spark.createDataFrame([(1, [1, 50_256_000])], "doc_id long, ids array<int>")
    with pytest.raises(Exception, match="no token has id 50256000"):
        B.decode(df).collect()
    df = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert [bytes(r.decoded) for r in B.decode(df).collect()] == [b"", b""]


B_PATTERN = __import__("public_tokenizers").PATTERN
