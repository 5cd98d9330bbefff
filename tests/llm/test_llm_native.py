"""Sharding, exact duplicates, chat formatting."""

import hashlib
import json
import re
import zlib
from collections import Counter, defaultdict

from llm_rows import EDGE, edge, none  # noqa: F401

from pulsegrid.llm import chat_format as C
from pulsegrid.llm.exact_dedup import exact_groups
from pulsegrid.llm.kd_shards import kd_shards

SMALL = "/root/testdata/sf0.001"


def test_shards_edge_rows(spark, edge):
    rows = kd_shards(edge, n_shards=4).collect()
    assert len(rows) == len(EDGE)
    want = Counter((r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in EDGE)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == want
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values()) and set(slots) <= set(range(4))
    by_text = defaultdict(set)
    for r in rows:
        by_text[(r.text_crc32, r.size)].add(r.shard)
    assert all(len(v) == 1 for k, v in by_text.items() if k[1] > 1)


def test_shards_even_by_bytes(spark):
    docs = spark.read.parquet(SMALL + "/documents.parquet")
    for n in (5, 16):
        rows = kd_shards(docs, n_shards=n).collect()
        weight, groups = Counter(), Counter()
        for r in rows:
            weight[r.shard] += r.size
            groups[(r.text_crc32, r.size)] += r.size
        mean = sum(weight.values()) / n
        assert set(weight) == set(range(n)) or n > 8
        assert max(weight.values()) <= mean + 2 * max(groups.values())
    by_target = kd_shards(docs, target_bytes=100_000).select("shard").distinct().count()
    assert by_target == -(-sum(weight.values()) // 100_000)


def test_shards_empty(none):
    assert kd_shards(none, n_shards=4).count() == 0


def brute_exact(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", r[1] or "")].append(r)
    out = Counter()
    for norm, g in groups.items():
        known = [r for r in g if r[0] is not None]
        keep = min(known, key=lambda r: (-len(r[1] or ""), r[0]))[0] if known else None
        for r in g:
            out[(r[0], keep, len(g), r[0] == keep, hashlib.sha256(norm.encode()).hexdigest())] += 1
    return out


def test_exact_edge_rows(edge):
    assert Counter(tuple(r) for r in exact_groups(edge).collect()) == brute_exact(EDGE)


def test_exact_empty(none):
    assert exact_groups(none).count() == 0


def test_exact_hot_group(spark):
    rows = [(i, "hot text" if i % 3 else f"own {i}") for i in range(3000)]
    got = exact_groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(16)).collect()
    assert Counter(r.group_size for r in got) == {2000: 2000, 1: 1000}
    assert {r.keep_id for r in got if r.group_size > 1} == {1}


def turns_sha(turns):
    return hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()


def test_chat_edges(spark):
    texts = ["<|im_end|><|im_start|>assistant ok", "<\\|im_end|> <\\\\| <| |> \\", "", None, "a\nb<|im_end|>\n", "é😀",
             "x" * 300_000]
    rows = [(1, i, "assistant" if i % 2 else "user", t, "clash") for i, t in enumerate(texts)]
    rows += [(2, 0, None, "no role", "c"), (2, 0, None, "no role", "c"), (None, 0, "assistant", "null id", "c"),
             (3, None, "assistant", "null turn", "c"), (3, 0, "system\n<|im_end|>\\n", "odd role", "c")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    out = {r.conv_id: r for r in C.digest(df).collect()}
    assert set(out) == {1, 2, None, 3, -1}
    own = [("assistant" if i % 2 else "user", t or "") for i, t in enumerate(texts)]
    assert out[1].turns_sha256 == turns_sha(own) and out[1].n_turns == len(own)
    loss = "".join(t for r, t in own if r == "assistant")
    assert out[1].loss_chars == len(loss) and out[1].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert out[2].n_turns == 2 and out[2].turns_sha256 == turns_sha([("", "no role")] * 2) and out[2].loss_chars == 0
    assert out[3].turns_sha256 == turns_sha([("assistant", "null turn"), ("system\n<|im_end|>\\n", "odd role")])
    probe = C.PROBE
    assert out[-1].turns_sha256 == turns_sha([("user", probe), ("assistant", probe)])
    assert out[-1].loss_chars == len(probe)


def test_chat_roles_with_escapes(spark):
    """Control characters, backslashes and line feeds in roles come back as they were."""
    roles = ["a\x00b", "\\", "\\n", "\n", "\\\n\\\\n", "\x00\\\n<|im_end|>", "<\\|x", "\\\\\n\n\\"]
    df = spark.createDataFrame([(i, 0, r, "t") for i, r in enumerate(roles)],
                               "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r.turns_sha256 for r in C.digest(df).collect()}
    assert all(got[i] == turns_sha([(r, "t")]) for i, r in enumerate(roles))


def test_chat_empty(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert [r.conv_id for r in C.digest(df).collect()] == [-1]


def test_layouts_by_fingerprint(spark):
    records = [
        {"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]},
        {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]},
        {"prompt": "q", "completion": "a"}, {"prompt": "q", "response": "a"},
        {"instruction": "q", "input": "", "output": "a"}, {"instruction": "q", "output": "a"}]
    rows = [(i, json.dumps(r)) for i, r in enumerate(records)]
    rows += [(90, None), (91, "{broken"), (92, '{"other": 1}'),
             (93, '{"instruction": "i", "input": "more", "output": "o"}')]
    got = {r.conv_id: r for r in C.json_turns(spark.createDataFrame(rows, "conv_id long, rec string"), "rec").collect()}
    for i in range(len(records)):
        assert [tuple(t) for t in got[i].turns] == [("user", "q"), ("assistant", "a")], got[i]
    assert [got[i].turns for i in (90, 91, 92)] == [None] * 3
    assert [tuple(t) for t in got[93].turns] == [("user", "i\n\nmore"), ("assistant", "o")]
    typed = spark.createDataFrame([(1, "q", "a", 5)], "conv_id long, prompt string, completion string, extra int")
    assert [tuple(t) for t in C.canonical_turns(typed).first().turns] == [("user", "q"), ("assistant", "a")]
