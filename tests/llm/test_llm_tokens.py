"""Token store and packing against the tokenizer itself."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_rows import EDGE, edge, none  # noqa: F401

from pulsegrid.llm import packing as P
from pulsegrid.llm import token_store as S
from pulsegrid.llm.tokens import encoder, vocabulary_path

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(vocabulary_path())


def ids_of(tokenizer, text, end):
    return np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, end], "<u4")


def small_rows(spark):
    return [tuple(r) for r in spark.read.parquet(SMALL + "/documents.parquet").select("doc_id", "text").collect()]


def test_encoder_equals_tokenizer(spark, tokenizer):
    odd = ["ÉCOLE, école. naïve!", "ﬁ ligature ½ ²", "Ǆ ǅ", "a.b..c,,d", "it's we'll 's", "\x1c\x85 x", "<|startoftext|>hi",
           "x" * 200, "ÿŸ ßẞ", "..." * 50, "don’t", "́ alone", "áb.", "ĀB.", "µ µ.", "日本。語"]
    for t in [*odd, *[r[1] for r in EDGE if r[1]], *[r[1] for r in small_rows(spark)]]:
        want = tokenizer.encode(t, add_special_tokens=False).ids
        assert np.frombuffer(encoder().encode(t.encode()), "<u4").tolist() == want, t[:80]


def check_store(rows, got, tokenizer):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    want, at = Counter(), 0
    for i, t, *_ in order:
        ids = ids_of(tokenizer, t, 2)
        want[(i, at, len(ids), zlib.crc32(ids.tobytes()))] += 1
        at += len(ids)
    assert Counter(tuple(r)[:4] for r in got) == want


def test_store_round_trip(spark, tokenizer, edge, tmp_path_factory):
    check_store(EDGE, S.store_digest(edge).collect(), tokenizer)
    rows = small_rows(spark)
    path = str(tmp_path_factory.mktemp("store") / "s")
    S.write_store(spark.read.parquet(SMALL + "/documents.parquet").repartition(7), path)
    got = S.read_store(spark, path, with_ids=True).collect()
    check_store(rows, got, tokenizer)
    texts = dict(rows)
    assert all(bytes(r.ids) == ids_of(tokenizer, texts[r.doc_id], 2).tobytes() for r in got)
    found = {r.doc_id: bytes(r.ids) for r in S.lookup(spark, path, [3, 77, 10 ** 9]).collect()}
    assert found == {i: ids_of(tokenizer, texts[i], 2).tobytes() for i in (3, 77)}


def test_store_empty(none):
    assert S.store_digest(none).count() == 0


def check_pieces(rows, got, tokenizer):
    docs = defaultdict(list)
    for i, t, *_ in rows:
        docs[i].append(ids_of(tokenizer, t, 1))
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(pieces) == set(docs)
    for i, texts in docs.items():
        want = Counter()
        for ids in texts:
            want[len(ids)] += len(ids)
        have = Counter()
        for r in pieces[i]:
            have[r.doc_tokens] += r.length
            assert any(len(x) == r.doc_tokens and
                       zlib.crc32(x[r.start:r.start + r.length].tobytes()) == r.ids_crc32 for x in texts)
        assert want == have
    for s in sequences.values():
        at = 0
        for r in sorted(s, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= P.SEQUENCE and all(r.sequence_length == at for r in s)
    return sequences


def test_packing(spark, tokenizer, edge, none, monkeypatch):
    check_pieces(EDGE, P.pack(edge).collect(), tokenizer)
    assert P.pack(none).count() == 0
    docs = spark.read.parquet(SMALL + "/documents.parquet")
    whole = check_pieces(small_rows(spark), P.pack(docs).collect(), tokenizer)
    monkeypatch.setattr(P, "RANGE_BYTES", 20_000)        # many short streams
    check_pieces(small_rows(spark), P.pack(docs).collect(), tokenizer)
    ids = sum(r.length for s in whole.values() for r in s)
    ranges = len({k >> 33 for k in whole})
    assert (len(whole) - ranges) * P.SEQUENCE <= ids * 1.01


def test_stream_is_one_plan(monkeypatch):
    """Positions found in lots of any size give the cuts of one plan over the whole stream, and the
    pieces hold every id once."""
    rng = np.random.default_rng(0)
    flags = np.zeros(100, bool)
    flags[[3, 4]] = True
    for t in range(45):
        size = int(rng.integers(40, 300))
        docs = [rng.integers(2, 100 if rng.random() < 0.7 else 5, int(rng.integers(1, 400))).astype("<u4") for _ in range(60)]
        if t % 3 == 0:      # no sentence ever ends
            docs = [np.where(np.isin(d, (3, 4)), 9, d).astype("<u4") for d in docs]
        ids = np.concatenate(docs)
        pos, cost = P.candidates(len(ids), np.cumsum([len(d) for d in docs]), np.flatnonzero(flags[ids]) + 1)
        want = P.plan_cuts(pos, cost, size)
        for group in (1, 64, 500, 1 << 40):
            monkeypatch.setattr(P, "GROUP", group)
            stream = P._Stream(flags, size)
            for d, x in enumerate(docs):
                stream.add(d, x.tobytes())
            rows = list(stream.rows(5))
            assert stream.plan.cuts() == want
            assert [r[5] for r in rows] == [5 + int(np.searchsorted(want, at, "right")) for at in np.cumsum([0, *[r[2] for r in rows]])[:-1]]
            assert all(zlib.crc32(docs[d][lo:lo + n].tobytes()) == crc and whole == len(docs[d])
                       for d, lo, n, crc, whole, *_ in rows)
            assert sum(r[2] for r in rows) == len(ids) and all(r[7] <= size for r in rows)


def test_packing_of_one_hot_id(spark, tokenizer):
    rows = [(7 if i % 3 else None, f"text {i} of one id " * (i % 5)) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    check_pieces(rows, P.pack(df).collect(), tokenizer)
    dealt = S.store_digest(df)
    assert dealt.count() == 600 and sorted(r.start for r in dealt.collect())[0] == 0


def brute_cost(pos, cost, size):
    best = {0: 0}
    for p, c in zip(pos, cost):
        best[p] = min(best[q] + size - (p - q) + c for q in best if p - q <= size)
    return best[pos[-1]]


def test_plan_is_optimal():
    rng = np.random.default_rng(2)
    for _ in range(60):
        total = int(rng.integers(1, 400))
        docs = np.unique(np.append(rng.integers(1, total + 1, 4), total))
        soft = np.unique(rng.integers(1, total + 1, 20))
        pos, cost = P.candidates(total, docs, soft)
        size = 40
        if np.diff(np.concatenate([[0], pos])).max() > size:
            continue
        ends = P.plan_cuts(pos, cost, size)
        at = dict(zip(pos.tolist(), cost.tolist()))
        told = sum(size - (b - a) + at[b] for a, b in zip([0, *ends], ends))
        assert ends[-1] == total and told == brute_cost(pos.tolist(), cost.tolist(), size)
