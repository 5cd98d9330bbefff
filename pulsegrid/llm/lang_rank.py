"""Language ID: rank-order profiles compared by out-of-place distance.

A profile is the ``TOP`` most frequent 1- to 3-grams of a language's letters
(words padded with a blank).  A document's own most frequent n-grams are
compared with each profile: the distance adds up how far each n-gram is out of
its place, ``TOP`` where the profile lacks it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pulsegrid.llm.common import crc_text, worker_state

TOP = 400
SAMPLE_DOCS = 8000        # documents a language's profile is learned from, at most
UNKNOWN = "und"
_BITS = 20                # bits of a letter's code point (none lies above plane 3)
_SPLIT = 1 << 16          # characters counted at once, so a huge text needs little memory


def _letters() -> np.ndarray:
    """Which code points are letters (built once per worker)."""
    state = worker_state()
    if not hasattr(state, "letters"):
        state.letters = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return state.letters


def letter_codes(text: str | None) -> np.ndarray:
    """Lower-case letters as code points; every run of anything else is one 0, also at both ends."""
    if not text:
        return np.zeros(1, np.uint32)
    c = np.frombuffer(text.lower().encode("utf-32-le", "replace"), "<u4")
    c = np.where(_letters()[c], c, 0)
    c = np.concatenate([np.zeros(1, c.dtype), c, np.zeros(1, c.dtype)])
    return c[np.concatenate([[True], (c[1:] != 0) | (c[:-1] != 0)])]


def grams(c: np.ndarray, bits: int, kind, starts: int | None = None) -> np.ndarray:
    """Packed 1-, 2- and 3-grams of padded words that begin at the first ``starts`` places.

    A blank alone is no 1-gram; a leading blank shows in 3-grams only, told
    from 2-grams by a bit above all codes.
    """
    c = c.astype(kind)
    k = len(c) if starts is None else starts
    one, two, three = c[:k], c[:-1][:k], c[:-2][:k]
    two = ((two << kind(bits)) | c[1:][:k])[two != 0]
    three = ((three << kind(2 * bits)) | (c[1:-1][:k] << kind(bits)) | c[2:][:k])[c[1:-1][:k] != 0]
    return np.concatenate([one[one != 0], two, three | (kind(1) << kind(3 * bits))])


def counted(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    s = np.sort(values)
    if not len(s):
        return s, np.empty(0, np.int64)
    first = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
    return s[first], np.diff(np.concatenate([first, [len(s)]]))


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = 3,
          held_out: int = 1) -> dict[str, list[int]]:
    """Profiles {lang: n-grams by falling frequency} from whole texts outside the held-out fold.

    At most ``SAMPLE_DOCS`` documents per language teach it; rows with a null
    language teach nothing.  Ties of frequency go by the n-gram's code.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    rows = rows.filter("lang IS NOT NULL AND text IS NOT NULL").filter(
        F.coalesce(F.pmod(crc_text("id"), F.lit(folds)) != held_out, F.lit(False)))
    # a hash threshold from each language's own count keeps a few more than the bound; the cut is by that hash
    h = F.pmod(F.xxhash64("id", "lang"), F.lit(1 << 30))
    large = rows.groupBy("lang").count().filter(F.col("count") > SAMPLE_DOCS)
    share = F.least(F.lit(1.0), F.lit(1.25 * SAMPLE_DOCS) / F.col("count"))
    large = large.select(F.col("lang").alias("_lang"), (share * (1 << 30)).cast("long").alias("_below"))
    few = rows.select("id", "lang", h.alias("_h")).join(F.broadcast(large), F.col("lang") == F.col("_lang"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("_h", "id"))
    last = few.filter("_h < _below").withColumn("_n", place).filter(F.col("_n") <= SAMPLE_DOCS).groupBy("lang").agg(
        F.max(F.struct("_h", "id")).alias("_last")).withColumnRenamed("lang", "_lang")
    rows = rows.withColumn("_key", F.struct(h.alias("_h"), "id")).join(F.broadcast(last), F.col("lang") == F.col("_lang"),
                                                                       "left")
    rows = rows.filter("_last IS NULL OR _key <= _last").select("text", "lang")

    def run(batches):
        for b in batches:
            texts, langs = b.column(0).to_pylist(), b.column(1).to_pylist()
            for lang in sorted(set(langs)):
                own = [t for t, x in zip(texts, langs) if x == lang]
                for lo in range(0, len(own), 50):
                    g, n = counted(np.concatenate([grams(letter_codes(t), _BITS, np.uint64) for t in own[lo:lo + 50]]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(g), pa.string()), pa.array(g.astype(np.int64)), pa.array(n)],
                        names=["lang", "gram", "n"])
    counts = rows.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    top = counts.withColumn("rank", rank).filter(F.col("rank") <= TOP).collect()    # TOP rows per language
    out: dict[str, list[int]] = {}
    for r in sorted(top, key=lambda r: (r["lang"], r["rank"])):
        out.setdefault(r["lang"], []).append(r["gram"])
    return out


class Profiles:
    """Profiles recoded to a small alphabet, so that a document's n-grams are 32-bit numbers."""

    def __init__(self, profiles: dict[str, list[int]]):
        self.langs = sorted(profiles)
        mask = (1 << _BITS) - 1
        chars = sorted({(g >> s) & mask for p in profiles.values() for g in p for s in (0, _BITS, 2 * _BITS)} - {0})
        self.bits = max(2, (len(chars) + 1).bit_length())
        self.chars = np.array(chars, np.uint32)
        code = {c: i + 1 for i, c in enumerate(chars)} | {0: 0}
        kind = np.uint32 if 3 * self.bits + 1 <= 32 else np.uint64
        self.kind = kind
        self.known = []
        for lang in self.langs:
            g = [self._recode(x, code, mask) for x in profiles[lang]]
            order = np.argsort(np.array(g, kind))
            self.known.append((np.array(g, kind)[order], order.astype(np.int64)))

    def _recode(self, g: int, code: dict, mask: int) -> int:
        three = g >> (3 * _BITS)
        a, b, c = (code[(g >> s) & mask] for s in (2 * _BITS, _BITS, 0))
        return (three << (3 * self.bits)) | (a << (2 * self.bits)) | (b << self.bits) | c

    def top_grams(self, text: str | None) -> np.ndarray:
        """The document's n-grams, most frequent first (ties by code); letters outside all profiles share a code."""
        c = letter_codes(text)
        at = np.searchsorted(self.chars, c)
        at_safe = np.minimum(at, len(self.chars) - 1)
        c = np.where(c == 0, 0, np.where(self.chars[at_safe] == c, at + 1, len(self.chars) + 1))
        parts = [counted(grams(c[lo:lo + _SPLIT + 2], self.bits, self.kind, _SPLIT)) for lo in range(0, len(c), _SPLIT)]
        if len(parts) == 1:
            g, n = parts[0]
        else:
            g, n = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
            order = np.argsort(g, kind="stable")
            first = np.flatnonzero(np.concatenate([[True], g[order][1:] != g[order][:-1]]))
            g, n = g[order][first], np.add.reduceat(n[order], first)
        return g[np.argsort(-n, kind="stable")[:TOP]]

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.langs:
            return UNKNOWN, 0.0
        g = self.top_grams(text)
        if not len(g):
            return UNKNOWN, 0.0
        place = np.arange(len(g))
        best, name = None, UNKNOWN
        for lang, (known, rank) in zip(self.langs, self.known):
            at = np.minimum(np.searchsorted(known, g), len(known) - 1)
            d = int(np.where(known[at] == g, np.abs(rank[at] - place), TOP).sum())
            if best is None or d < best:
                best, name = d, lang
        return name, max(0.0, 1.0 - best / (TOP * len(g)))


def predict(docs: DataFrame, profiles: dict[str, list[int]], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score`` of every whole text.

    Score: 1 minus the distance as a share of the largest possible.  Null
    texts and texts without a letter are ``und`` with score 0, as is every
    text when nothing was learned.  Ties go to the language first by name.
    """
    model = Profiles(profiles)

    def run(batches):
        for b in batches:
            got = [model.predict(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())],
                names=["doc_id", "lang_pred", "score"])
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double")


def language_rows(docs: DataFrame) -> DataFrame:
    out = predict(docs, learn(docs))
    return out.select("doc_id", (F.pmod(crc_text("doc_id"), F.lit(3)) == 1).alias("held_out"), "lang_pred", "score")
