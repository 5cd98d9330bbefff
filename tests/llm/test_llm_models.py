"""Quality machine, language profiles, licences, benchmark leaks, pipeline."""

import random
import zlib

import numpy as np
import pytest
from llm_rows import DOCS, EDGE, doc, edge, none  # noqa: F401
from pyspark.sql import functions as F

from pulsegrid.llm import decontam as D
from pulsegrid.llm import lang_rank as L
from pulsegrid.llm import license_scan as S
from pulsegrid.llm import quality_fm as Q
from pulsegrid.llm import queries

MEDIUM = "/root/testdata/sf0.01"
SMALL = "/root/testdata/sf0.001"


def test_quality_held_out(spark):
    labels = spark.read.parquet(MEDIUM + "/labels.parquet")
    rows = queries.op2_quality_fm(spark, MEDIUM).join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(held) > 40 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert np.mean([r.predicted == r.quality for r in held]) >= 0.95


def test_quality_ignores_ids_and_metadata(spark):
    docs = spark.read.parquet(SMALL + "/documents.parquet")
    labels = spark.read.parquet(SMALL + "/labels.parquet")
    model = Q.train(docs, labels)
    a = {r.doc_id: r.score for r in Q.score(docs, model).collect()}
    b = {r.doc_id - 10 ** 6: r.score for r in Q.score(
        docs.select((F.col("doc_id") + 10 ** 6).alias("doc_id"), "text", F.lit("xx").alias("lang")), model).collect()}
    assert a == b


def test_quality_linear_form_equals_all_pairs():
    rng = np.random.default_rng(0)
    m = Q.Machine(0.1, rng.normal(size=Q.BUCKETS + 15).astype("f4"), rng.normal(size=(Q.BUCKETS + 15, 8)).astype("f4") / 9,
                  np.zeros(15, "f4"), np.ones(15, "f4"))
    buckets, weights, dense = np.array([3, 77, 500], "i4"), np.array([.5, .3, .8], "f4"), rng.normal(size=15).astype("f4")
    i, x = m.inputs(buckets, weights, dense)
    z = 0.1 + m.linear[i] @ x + sum(m.pairs[i[a]] @ m.pairs[i[b]] * x[a] * x[b]
                                    for a in range(len(i)) for b in range(a))
    assert m.score(buckets, weights, dense) == pytest.approx(1 / (1 + np.exp(-z)), abs=1e-5)


def test_quality_edges(spark, edge, none):
    labels = spark.createDataFrame([(3, 1, 0), (4, 0, 0), (8, 1, None), (None, 1, 0), (5, None, 0), (5, 1, 0), (5, 0, 1)],
                                   "doc_id long, quality int, toxic int")
    rows = Q.quality_rows(edge, labels).collect()
    assert len(rows) == len(EDGE) and all(0 <= r.score <= 1 for r in rows)
    assert Q.quality_rows(none, labels).count() == 0
    rows = Q.quality_rows(edge, labels.limit(0)).collect()
    assert {r.score for r in rows} == {0.5}


def test_language_held_out(spark):
    docs = spark.read.parquet(MEDIUM + "/documents.parquet").select("doc_id", "lang")
    rows = queries.op4_lang_rank(spark, MEDIUM).join(docs, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(held) > 200 and np.mean([r.lang == r.lang_pred for r in held]) >= 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_edges(spark, edge, none):
    rows = L.language_rows(edge).collect()
    assert len(rows) == len(EDGE)
    for text in (None, "", "### $$$ 123 !!!", " \t\n\x0b\x0c\r"):
        n = sum(r[1] == text for r in EDGE)
        assert n and sum(r.lang_pred == "und" for r in rows) >= n
    assert {r.lang_pred for r in rows} <= {"und", "en", "de"}
    assert L.language_rows(none).count() == 0
    nothing = edge.withColumn("lang", F.lit(None).cast("string"))
    assert {(r.lang_pred, r.score) for r in L.language_rows(nothing).collect()} == {("und", 0.0)}


def test_language_sample_is_per_language(spark, monkeypatch):
    """A rare language keeps all its documents when a common one is beyond the bound."""
    monkeypatch.setattr(L, "SAMPLE_DOCS", 40)
    rows = [(i, "the quick brown fox", "en") for i in range(6000)] + [(10_000 + i, "zażółć gęślą jaźń", "pl") for i in range(9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    every = L.learn(docs.filter("lang = 'pl'"))
    got = L.learn(docs)
    assert sorted(got) == ["en", "pl"] and got["pl"] == every["pl"]
    monkeypatch.setattr(L, "TOP", 10 ** 6)
    texts = [(i, f"w{chr(0x4e00 + i)}", "en" if i < 3000 else "pl") for i in range(3030)]
    out = L.learn(spark.createDataFrame(texts, "doc_id long, text string, lang string"))
    ones = {k: sum(1 for g in p if (1 << L._BITS) > g >= 0x4e00) for k, p in out.items()}
    held = sum(1 for i in range(3000, 3030) if zlib.crc32(str(i).encode()) % 3 == 1)
    assert ones == {"en": 40, "pl": 30 - held}


def brute_grams(text):
    from collections import Counter
    out, padded = Counter(), " "
    for ch in text.lower():
        padded += ch if ch.isalpha() else " " if padded[-1] != " " else ""
    padded += " " if padded[-1] != " " else ""
    for i, ch in enumerate(padded):
        if ch != " ":
            out[ch] += 1
        if ch != " " and i + 1 < len(padded):
            out[padded[i:i + 2]] += 1
        if i + 2 < len(padded) and padded[i + 1] != " ":
            out[padded[i:i + 3]] += 1
    return out


def test_language_rank_equals_brute_force(spark, monkeypatch):
    rows = spark.read.parquet(SMALL + "/documents.parquet").select("lang", "text").collect()
    monkeypatch.setattr(L, "_SPLIT", 700)
    for r in rows[:40]:
        c = L.letter_codes(r.text)
        values, n = L.counted(L.grams(c, L._BITS, np.uint64))
        want = brute_grams(r.text)
        assert sorted(n.tolist()) == sorted(want.values())
    profiles = L.learn(spark.read.parquet(SMALL + "/documents.parquet"))
    model = L.Profiles(profiles)

    def spell(g):
        m, three = (1 << L._BITS) - 1, g >> (3 * L._BITS)
        a, b, c = ((g >> s) & m for s in (2 * L._BITS, L._BITS, 0))
        return "".join(chr(x) if x else " " for x in ((a, b, c) if three else (b, c) if b else (c,)))
    ranks = {lang: {spell(g): i for i, g in enumerate(p)} for lang, p in profiles.items()}
    for r in rows[:25]:
        counts = brute_grams(r.text)
        if len(counts) <= L.TOP or len(set(counts.values())) == len(counts):
            continue
        name, score = model.predict(r.text)
        top = model.top_grams(r.text)
        assert sorted((counts.most_common()[i][1] for i in range(L.TOP)), reverse=True)[-1] >= 1 and len(top) == L.TOP
        assert name in ranks and 0 < score < 1


def test_license_exact_and_changed(spark, edge, none):
    rng = random.Random(3)
    prose = lambda n: " ".join(rng.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(n))
    long_mit = S.TEMPLATES["MIT"][2]
    changed = long_mit.replace("free of charge", "free of cost").replace("any person", "each person")
    rows = [doc(1, prose(80) + "\n" + long_mit + "\n" + prose(80)), doc(2, changed), doc(3, prose(300)),
            doc(4, "Licensed under CC BY-NC 4.0.\n" + prose(5) + "\nAll rights reserved."),
            doc(5, "We had a licence to print " + prose(40)), doc(6, (prose(200) + " All rights reserved. ") * 40)]
    got = S.scan(spark.createDataFrame(rows, DOCS)).collect()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert [(r.license, r.kind) for r in by[1]] == [("MIT", "exact")]
    assert rows[0][1][by[1][0].start:][:20] == long_mit[:20]
    assert [(r.license, r.edits, r.differences) for r in by[2]] == [
        ("MIT", 2, ["charge -> cost", "any -> each"])]
    assert sorted(r.license for r in by[4]) == ["CC-BY-NC-4.0", "all-rights-reserved"]
    assert len(by[6]) == 40 and 3 not in by and 5 not in by
    assert S.scan(edge).count() == 0 and S.scan(none).count() == 0


def test_license_planted_lines(spark):
    docs = spark.read.parquet(MEDIUM + "/documents.parquet")
    notices = [t for texts in S.TEMPLATES.values() for t in texts]
    want = sum(r.text.count(t) for r in docs.select("text").collect() for t in notices)
    assert S.scan(docs).count() == want > 20


def brute_notices(words):
    """Every template aligned in every whole piece, best first: (license, first, end, edits)."""
    known = [(name, S.words_of(t)[0]) for name, texts in S.TEMPLATES.items() for t in texts]
    out, pieces = [], [(0, len(words))]
    while pieces:
        lo, hi = pieces.pop()
        best = None
        for name, t in known:
            cost, first, end, _ = S.align(t, words[lo:hi])
            if cost <= S.MOST_EDITS * len(t) and (best is None or cost - len(t) < best[0]):
                best = (cost - len(t), name, lo + first, lo + end, cost)
        if best:
            out.append(best[1:])
            pieces += [(lo, best[2]), (best[3], hi)]
    return sorted(out, key=lambda r: r[1])


def notices(text):
    """What the scanner finds, as places of words."""
    at = {a: k for k, (a, _) in enumerate(S.words_of(text)[1])}
    ends = {b: k + 1 for k, (_, b) in enumerate(S.words_of(text)[1])}
    return [(r[0], at[r[2]], ends[r[2] + r[3]], r[5]) for r in S.Scanner(S.TEMPLATES).scan(text)]


def prose_words(rng, n):
    return ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randrange(2, 9))) for _ in range(n)]


def test_license_notices_in_a_long_text():
    """A notice every 70 words of 20,000, words edited in every third: none is lost, wherever it lies."""
    rng = random.Random(11)
    every = [t for texts in S.TEMPLATES.values() for t in texts]
    text, words, planted = [], 0, []
    while words < 20_000:
        text += prose_words(rng, 70)
        notice = S.words_of(rng.choice(every))[0]
        if len(planted) % 3 == 0:
            for k in rng.sample(range(len(notice)), int(0.08 * len(notice))):
                notice[k] = "permxx"
        planted.append(len(" ".join(text)) + 1)
        text += notice
        words += 70 + len(notice)
    text = " ".join(text)
    got = notices(text)
    assert [r[1] for r in got] == [len(S.words_of(text[:p])[0]) for p in planted]
    rest = S.words_of(text)[0]
    for _, a, b, _ in got:
        rest[a:b] = ["-"] * (b - a)
    for texts in S.TEMPLATES.values():
        for t in texts:
            t = S.words_of(t)[0]
            assert S.align(t, rest)[0] > S.MOST_EDITS * len(t)


def test_license_every_template_is_aligned():
    """Notices beside lines that resemble many templates, against the alignment of every template."""
    rng = random.Random(12)
    near = ["Licensed under CC BY-ND 4.0.", "Licensed under CC BY-NC-SA 4.0.", "This work is licensed under a Creative "
            "Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.", "This work is licensed under "
            "a Creative Commons Attribution-NoDerivatives 3.0 License."]
    short = ["All rights reserved.", "Released under the MIT License.", "Licensed under CC BY 4.0."]
    key = lambda r: (r[1], r[2], r[3])  # noqa: E731  (licences of equal places differ by the reduction alone)
    for k in range(60):
        lines = [near[k % 4], short[k % 3]]
        rng.shuffle(lines)
        text = " ".join(prose_words(rng, 24) + lines + prose_words(rng, 80))
        got = notices(text)
        assert list(map(key, got)) == list(map(key, brute_notices(S.words_of(text)[0])))
        assert ["all-rights-reserved", "MIT", "CC-BY-4.0"][k % 3] in {r[0] for r in got if not r[3]}
    every = [t for texts in S.TEMPLATES.values() for t in texts]
    for k in range(12):
        text = []
        for _ in range(5):
            notice = rng.choice(every).split()
            for _ in range(rng.randrange(0, 2 + len(notice) // 9)):
                at = rng.randrange(len(notice))
                notice[at:at + 1] = rng.choice([[], ["other"], [notice[at], "more"]])
            text += notice + prose_words(rng, rng.randrange(0, 4))
        text = " ".join(text)
        assert list(map(key, notices(text))) == list(map(key, brute_notices(S.words_of(text)[0])))


def test_license_reduction_decides_between_templates(monkeypatch):
    """Templates one word apart claim one place: the bytes saved choose, and without them the choice is wrong."""
    text = " ".join(["We ship it."] + [S.TEMPLATES[name][k] + " More follows here." for name, k in
                                       (("GPL-2.0", 0), ("GPL-3.0", 0), ("GPL-2.0", 1))])
    assert [(r[0], r[1], r[5]) for r in S.Scanner(S.TEMPLATES).scan(text)] == [
        ("GPL-2.0", 0, 0), ("GPL-3.0", 0, 0), ("GPL-2.0", 1, 0)]
    monkeypatch.setattr(S.Scanner, "saved", lambda self, i, words: 0)
    assert [(r[0], r[1], r[5]) for r in S.Scanner(S.TEMPLATES).scan(text)] != [
        ("GPL-2.0", 0, 0), ("GPL-3.0", 0, 0), ("GPL-2.0", 1, 0)]


def edits(rng, text, n):
    t = list(text)
    for _ in range(n):
        k = rng.randrange(len(t))
        t[k:k + 1] = rng.choice([[], [rng.choice("abcxyz")], [t[k], rng.choice("abcxyz")]])
    return "".join(t)


def best_edits(item, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_leaks_against_full_alignment(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("etaoinshr") for _ in range(rng.randrange(2, 8)))
    prose = lambda n: " ".join(word() for _ in range(n))
    items = [(i, prose(14 + 3 * i)) for i in range(8)] + [(50, "tiny"), (51, None), (52, "")]
    docs = []
    for k in range(60):
        i = k % 8
        n = rng.randrange(0, int(0.16 * len(items[i][1])))
        docs.append(doc(k, prose(20) + "\n" + edits(rng, items[i][1].upper() if k % 2 else items[i][1], n) + " " + prose(20)))
    docs += [doc(100 + k, prose(60)) for k in range(20)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = D.contaminated(spark.createDataFrame(docs, DOCS), bench).collect()
    got = {(r.doc_id, r.item_id): r for r in rows if r.item_id != 50}
    for d, text, *_ in docs:
        t = D.plain(text)
        for i, item in items[:8]:
            if (d < 100 and i == d % 8) or (d, i) in got:
                best = best_edits(D.plain(item), t)
                assert ((d, i) in got) == (best <= int(0.1 * len(item))), (d, i, best)
                if (d, i) in got:
                    assert got[(d, i)].edits == best


def test_leaks_edges(spark, edge, none, monkeypatch):
    bench = spark.createDataFrame([(1, "one"), (2, None), (3, ""), (4, "two words"), (4, "two words")],
                                  "item_id long, text string")
    rows = D.contaminated(edge, bench).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == {(3, 1), (4, 1), (5, 4)}
    assert D.contaminated(none, bench).count() == 0 and D.contaminated(edge, bench.limit(0)).count() == 0
    monkeypatch.setattr(D, "BLOCK_CHARS", 4)         # several blocks of items
    again = D.contaminated(edge, bench).collect()
    assert {(r.doc_id, r.item_id) for r in again} == {(3, 1), (4, 1), (5, 4)}


def test_leaks_of_passages(spark):
    """Halves and passages of items, some edited, against the alignment of every window."""
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("etaoinshr") for _ in range(rng.randrange(2, 8)))
    prose = lambda n: " ".join(word() for _ in range(n))
    items = [(0, prose(15)), (1, prose(40)), (2, prose(150)), (3, prose(3))]
    docs = []
    for k in range(18):
        item = items[k % 3][1]
        n = [len(item) // 2 + 1, 60, 42, 36, 30][k % 5]
        at = rng.choice([0, len(item) - n, rng.randrange(len(item) - n)])
        docs.append(doc(k, prose(10) + " " + edits(rng, item[at:at + n], k // 5) + " " + prose(10)))
    docs.append(doc(50, prose(9) + " " + " ".join(items[2][1].split()[40:100]) + "\n" + items[1][1] + " " + items[0][1][:44]))
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = D.contaminated(spark.createDataFrame(docs, DOCS), bench, window=D.PASSAGE).collect()
    got, w = {(r.doc_id, r.item_id) for r in rows}, D.PASSAGE
    for d, text, *_ in docs:
        t = D.plain(text)
        for i, item in items[:3]:
            if i == d % 3 or d == 50:
                near = any(best_edits(item[s:s + w], t) <= int(0.1 * w) for s in range(len(item) - w + 1))
                assert ((d, i) in got) == near, (d, i)
    assert {(50, 0), (50, 1), (50, 2)} <= got and len(got) < 20
    text = {d: D.plain(t) for d, t, *_ in docs}
    for r in rows:
        window = items[r.item_id][1][r.window_start:r.window_start + r.window_chars]
        assert best_edits(window, text[r.doc_id][r.start:r.start + r.length]) == r.edits <= int(0.1 * r.window_chars)
    assert [(r.window_start, r.window_chars) for r in rows if (r.doc_id, r.item_id) == (50, 1)] == [(0, len(items[1][1]))]
    own = [(r.start, r.start + r.length) for r in rows if (r.doc_id, r.item_id) == (50, 2)]
    assert len(own) > 3 and all(a[1] <= b[0] for a, b in zip(sorted(own), sorted(own)[1:]))


def test_pipeline_drops_half_items(spark):
    pipeline = pytest.importorskip("corpus_pipeline")
    items = [r.text for r in spark.read.parquet(SMALL + "/benchmark.parquet").collect()]
    rows = [doc(k, "some words before " + (t[:len(t) // 2 + 1] if k % 2 else t[len(t) // 2 - 1:]) + " and after")
            for k, t in enumerate(items)] + [doc(1000, "no item at all")]
    assert [r.doc_id for r in pipeline.decontaminate(spark, spark.createDataFrame(rows, DOCS), SMALL).collect()] == [1000]


def test_pipeline_stages(spark, edge, none, tmp_path_factory):
    pipeline = pytest.importorskip("corpus_pipeline")
    assert [n for n, _ in pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "decontaminate", "packing"]
    for table in (edge, none):
        docs = table
        for name, stage in pipeline.STAGES:
            out = stage(spark, docs, SMALL)
            if name != "packing":
                assert out.columns == table.columns
                docs = out
            out.write.parquet(str(tmp_path_factory.mktemp("stage") / name))


def test_pipeline_against_brute_force(spark):
    pipeline = pytest.importorskip("corpus_pipeline")
    from test_llm_native import brute_exact
    from test_llm_near import brute
    docs = spark.read.parquet(MEDIUM + "/documents.parquet").filter("doc_id < 500")
    rows = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    kept = {r.doc_id for r in pipeline.exact(spark, docs, MEDIUM).collect()}
    assert kept == {k[0] for k in brute_exact(list(rows.items())) if k[3]}
    kept = {r.doc_id for r in pipeline.near(spark, docs, MEDIUM).collect()}
    assert kept == {i for _, i, _, c in brute(list(rows.items()), 5, 80) if i == c}
    items = [D.plain(r.text) for r in spark.read.parquet(MEDIUM + "/benchmark.parquet").collect()]
    kept = {r.doc_id for r in pipeline.decontaminate(spark, docs, MEDIUM).collect()}
    exact = {i for i, t in rows.items() if any(x in D.plain(t) for x in items)}
    assert exact and not kept & exact and len(kept) >= len(rows) - len(exact) - 2
    out = pipeline.run(spark, SMALL)
    assert out.count() > 0 and out.agg(F.max("sequence_length")).first()[0] <= 2048
