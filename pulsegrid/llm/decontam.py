"""Benchmark decontamination: q-gram lemma over overlapping diagonal bands, then banded alignment.

Texts and benchmark items are compared as lower-case characters with each run
of white space as one blank.  An item of m characters with at most k edits
shares at least m - q + 1 - k q of its q-grams with the place it was copied
to, all of them on diagonals at most k apart.  Shared q-grams are counted in
bands of 2 (k + 1) diagonals that overlap by half; bands that reach the bound
are regions, and an alignment of the item inside the region decides.

Passages are found the same way: every window of so many characters of a longer
item is an item of its own, with its own edit budget and bound.
"""

from __future__ import annotations

import uuid
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import worker_state

Q = 8
EDIT_SHARE = 0.1          # edits allowed, as a share of the item's characters
PASSAGE = 39              # characters of an item that make a leak of their own: half of a two-line question
BLOCK_CHARS = 8_000_000   # characters of benchmark items searched for in one pass over the documents
_MULT = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))
_FILTER_BITS = 20
ALIGN_ROWS = 4096         # candidate passages tried at once
TEXT_CHARS = 4_000_000    # characters of texts searched together, but for a longer single text

_SCHEMA = ("doc_id long, item_id long, start long, length long, edits int, item_chars int, shared_qgrams int, "
           "window_start int, window_chars int")
_NAMES = ["doc_id", "item_id", "start", "length", "edits", "item_chars", "shared_qgrams", "window_start",
          "window_chars"]


def plain(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def counted(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in order with their counts."""
    s = np.sort(values)
    first = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
    return s[first], np.diff(np.concatenate([first, [len(s)]]))


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")


def qgrams(c: np.ndarray) -> np.ndarray:
    """64-bit hashes of the Q-grams (Q = 8: pairs of pairs of pairs)."""
    h = c.astype(np.uint64)
    for step, mult in zip((1, 2, 4), _MULT):
        if len(h) <= step:
            return np.empty(0, np.uint64)
        h = h[:-step] * mult + h[step:]
        h ^= h >> np.uint64(29)
    return h * _MULT[0]


class Index:
    """Q-grams of the items with their places."""

    def __init__(self, items: list[tuple[int, str]], window: int | None = None):
        texts = [(i, plain(t)) for i, t in items]
        texts = [(i, t) for i, t in texts if t]
        self.ids = [i for i, _ in texts]
        self.texts = [t for _, t in texts]
        self.chars = np.array([len(t) for t in self.texts], np.int64)
        # an item shorter than Q must occur as it stands; others keep the bound at 1 or more
        self.budget = np.maximum(0, np.minimum((EDIT_SHARE * self.chars).astype(np.int64), (self.chars - Q) // Q))
        self.bound = self.chars - Q + 1 - self.budget * Q
        self.window = window
        if window is not None:
            self.window_budget = max(0, min(int(EDIT_SHARE * window), (window - Q) // Q))
            self.window_bound = window - Q + 1 - self.window_budget * Q
        self.points = [code_points(t) for t in self.texts]
        grams = [qgrams(c) for c in self.points]
        item = np.repeat(np.arange(len(grams)), [len(g) for g in grams]).astype(np.int64)
        place = np.concatenate([np.arange(len(g)) for g in grams] or [np.empty(0)]).astype(np.int64)
        flat = np.concatenate(grams or [np.empty(0, np.uint64)]).astype(np.uint64)
        order = np.argsort(flat, kind="stable")
        self.item, self.place = item[order], place[order]
        flat = flat[order]
        first = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]])) if len(flat) else np.empty(0, np.int64)
        self.keys = flat[first]
        self.first = np.concatenate([first, [len(flat)]]).astype(np.int64)
        self.seen = np.zeros(1 << _FILTER_BITS, bool)
        self.seen[(self.keys >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True
        self.short = [k for k in range(len(self.texts)) if self.chars[k] < Q]

    def shared(self, c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(item, place in the item, place in the text) of every shared q-gram."""
        none = np.empty(0, np.int64)
        h = qgrams(c)
        at = np.flatnonzero(self.seen[(h >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)]) if len(h) else h
        if not len(at) or not len(self.keys):
            return none, none, none
        k = np.minimum(np.searchsorted(self.keys, h[at]), len(self.keys) - 1)
        ok = self.keys[k] == h[at]
        at, k = at[ok], k[ok]
        if not len(at):
            return none, none, none
        n = self.first[k + 1] - self.first[k]
        begin = np.repeat(self.first[k], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return self.item[begin], self.place[begin], np.repeat(at, n)

    def regions(self, item: np.ndarray, place: np.ndarray, pos: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(item, lowest diagonal, highest diagonal, shared q-grams) of bands that reach their bound."""
        if not len(item):
            return []
        rich = np.bincount(item, minlength=len(self.ids)) >= self.bound      # enough in the whole text at all
        ok = rich[item]
        if not ok.any():
            return []
        item, place, pos = item[ok], place[ok], pos[ok]
        base = 2 * int(self.chars.max())                         # diagonals never fall below 0
        band = (pos - place + base) // (self.budget[item] + 1)   # half a band; a band is two neighbours
        width = int(band.max()) + 2
        key = item * width + band
        found, count = counted(key)
        near = np.where(found[1:] == found[:-1] + 1, count[1:], 0)
        both = count + np.concatenate([near, [0]])
        out = []
        for x in found[both >= self.bound[found // width]].tolist():
            # an item's place counts once, however often its q-gram repeats in the band
            i, b = divmod(x, width)
            shared = len(set(place[(key == x) | (key == x + 1)].tolist()))
            if shared >= self.bound[i]:
                step = int(self.budget[i]) + 1
                out.append((i, b * step - base, (b + 2) * step - 1 - base, shared))
        return out

    def windows(self, item: np.ndarray, place: np.ndarray, pos: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """(item, first place in the text, end, first character of the window, shared q-grams) of candidate windows.

        Every window of every item longer than it counts the places it shares
        within a band; both ends of a run of enough places bound its start.
        """
        if not len(item):
            return []
        least, step, last = self.window_bound, self.window_budget + 1, self.window - Q
        ok = (self.chars > self.window)[item]
        ok &= (np.bincount(item, minlength=len(self.ids)) >= least)[item]
        if not ok.any():
            return []
        item, place, pos = item[ok], place[ok], pos[ok]
        base = 2 * int(self.chars.max())
        band = (pos - place + base) // step
        width = int(band.max()) + 2
        # most half bands hold too few shared q-grams, even with repeats: they go before any sorting by place
        half = item * width + band
        keys, count = counted(half)
        near = np.concatenate([np.where(keys[1:] == keys[:-1] + 1, count[1:], 0), [0]])
        good = count + near >= least                     # bands by their lower half
        if not good.any():
            return []
        lower, upper = good, np.concatenate([[False], good[:-1] & (near[:-1] > 0)])
        used = np.searchsorted(keys, half)
        part = np.flatnonzero((lower | upper)[used])
        half, place, used = half[part], place[part], used[part]
        span = int(self.chars.max()) + 1
        both = np.unique(np.concatenate([half[lower[used]] * span + place[lower[used]],
                                         (half[upper[used]] - 1) * span + place[upper[used]]]))
        key, place = both // span, both % span
        n = len(key) - least + 1
        if n <= 0:
            return []
        run = (key[least - 1:] == key[:n]) & (place[least - 1:] - place[:n] <= last)
        out = []
        for k in np.unique(key[:n][run]).tolist():
            i, b = divmod(k, width)
            lo = b * step - base
            p = place[np.searchsorted(key, k):np.searchsorted(key, k, "right")]
            starts = np.arange(max(0, int(p[0]) - last), min(int(p[-1]), int(self.chars[i]) - self.window) + 1)
            same = np.searchsorted(p, starts + last, "right") - np.searchsorted(p, starts)
            out += [(i, lo + t - step + 1, lo + 2 * step + t + self.window + step - 1, t, c)
                    for t, c in zip(starts.tolist(), same.tolist()) if c >= least]
        return sorted(out)

    def alignable(self, candidates: list[tuple[np.ndarray, list]]) -> list[list]:
        """The candidate windows of each text that have a place within the budget anywhere in their region.

        Bit-parallel edit distance (a window's row of cost differences is one
        machine word) over the windows of all texts at once; which places stay
        is for the alignment to say.
        """
        every = [(k, w) for k, (_, found) in enumerate(candidates) for w in found]
        if not every or self.window > 64:
            return [found for _, found in candidates]
        out: list[list] = [[] for _ in candidates]
        size = max(b - a for _, (_, a, b, _, _) in every)
        for at in range(0, len(every), ALIGN_ROWS):
            part = every[at:at + ALIGN_ROWS]
            held = np.stack([self.points[i][s:s + self.window] for _, (i, _, _, s, _) in part])
            region = np.full((len(part), size), 0xFFFFFFFF, np.uint32)      # no character of any window
            for row, (k, (_, a, b, _, _)) in zip(region, part):
                text = candidates[k][0][max(0, a):max(0, b)]
                row[:len(text)] = text
            bits = np.uint64(1) << np.arange(self.window, dtype=np.uint64)
            top, one = np.uint64(self.window - 1), np.uint64(1)
            up, down = np.full(len(part), (1 << self.window) - 1, np.uint64), np.zeros(len(part), np.uint64)
            cost = np.full(len(part), self.window, np.int64)
            least = cost.copy()
            for j in range(size):
                same = ((held == region[:, j, None]) * bits).sum(axis=1, dtype=np.uint64)
                across = (((same & up) + up) ^ up) | same
                more, less = down | ~(across | up), up & across
                cost += ((more >> top) & one).astype(np.int64) - ((less >> top) & one).astype(np.int64)
                np.minimum(least, cost, out=least)
                more, less, same = more << one, less << one, same | down
                up, down = less | ~(same | more), more & same
            for (k, w), d in zip(part, least.tolist()):
                if d <= self.window_budget:
                    out[k].append(w)
        return out

    def find(self, text: str | None) -> list[tuple]:
        """(item_id, start, length, edits, item_chars, shared, window_start, window_chars) in the plain text.

        Overlapping finds of an item keep the best; a passage that overlaps a
        find of its whole item or an earlier passage of it is no further find.
        """
        return self.find_all([text])[0]

    def find_all(self, texts: list[str | None]) -> list[list[tuple]]:
        """``find`` of every text; candidate passages of all texts are tried together."""
        texts = [plain(t) for t in texts]
        whole, candidates = [], []
        for text in texts:
            c = code_points(text)
            hits = self.shared(c)
            found = self.whole_items(text, len(c), hits)
            whole.append(found)
            candidates.append((c, self.windows(*self.beside(found, *hits)) if self.window is not None else []))
        out = []
        for text, found, (c, _), tried in zip(texts, whole, candidates, self.alignable(candidates)):
            rows = [(self.ids[i], s, e - s, d, int(self.chars[i]), n, 0, int(self.chars[i]))
                    for i, kept in found.items() for d, s, e, n in kept]
            rows += self.passages(text, len(c), found, tried)
            out.append(sorted(rows, key=lambda r: (r[1], r[0])))
        return out

    def whole_items(self, text: str, n: int, hits: tuple) -> dict[int, list]:
        """item -> (edits, start, end, shared) of its places, overlapping ones resolved."""
        found: dict[int, list] = {}
        for i, lo, hi, shared in self.regions(*hits):
            budget, m = int(self.budget[i]), int(self.chars[i])
            a, b = max(0, lo - budget), min(n, hi + m + budget + 1)
            got = banded(self.texts[i], text[a:b], budget)
            if got is not None:
                edits, start, end = got
                found.setdefault(i, []).append((edits, a + start, a + end, shared))
        for k in self.short:
            at = text.find(self.texts[k])
            while at >= 0:
                found.setdefault(k, []).append((0, at, at + int(self.chars[k]), 0))
                at = text.find(self.texts[k], at + 1)
        for i, places in found.items():
            kept: list = []
            for edits, start, end, shared in sorted(places):
                if all(end <= s or start >= e for _, s, e, _ in kept):
                    kept.append((edits, start, end, shared))
            found[i] = kept
        return found

    @staticmethod
    def beside(found: dict[int, list], item: np.ndarray, place: np.ndarray, pos: np.ndarray) -> tuple:
        """The shared q-grams beside an item's finds: passages lie there, and so do their q-grams."""
        for i, kept in found.items():
            for _, x, y, _ in kept:
                ok = (item != i) | (pos + Q <= x) | (pos >= y)
                item, place, pos = item[ok], place[ok], pos[ok]
        return item, place, pos

    def passages(self, text: str, n: int, found: dict[int, list], tried: list) -> list[tuple]:
        """Rows of the passages among the windows tried, beside the finds so far."""
        out = []
        for i, a, b, s, shared in tried:
            kept = found.setdefault(i, [])
            free = [max(0, a), *(x for _, *place, _ in sorted(kept, key=lambda f: f[1]) for x in place
                                 if place[1] > a and place[0] < b), min(n, b)]
            for lo, hi in zip(free[::2], free[1::2]):
                if hi - lo < self.window - self.window_budget:
                    continue
                got = banded(self.texts[i][s:s + self.window], text[lo:hi], self.window_budget)
                if got is not None:
                    edits, start, end = got
                    kept.append((edits, lo + start, lo + end, shared))
                    out.append((self.ids[i], lo + start, end - start, edits, int(self.chars[i]), shared, s, self.window))
        return out


def banded(item: str, region: str, budget: int) -> tuple[int, int, int] | None:
    """(edits, start, end) of the item's best place in the region, None beyond the budget.

    Edit distance with free ends in the region.  Only diagonals that start
    inside the region are kept, one row per character of the item.
    """
    at = region.find(item)
    if at >= 0:
        return 0, at, at + len(item)
    if not budget:
        return None
    t, r = code_points(item), code_points(region)
    n = len(r)
    cost, start, steps = np.zeros(n + 1, np.int32), np.arange(n + 1), np.arange(n + 1)
    for i in range(1, len(t) + 1):
        swap, drop = cost[:-1] + (r != t[i - 1]), cost[1:] + 1
        row = np.concatenate([[i], np.minimum(swap, drop)])
        origin = np.concatenate([[0], np.where(swap <= drop, start[:-1], start[1:])])
        # insertions run to the right: the best earlier place plus the distance to it
        lead = row - steps
        best = np.minimum.accumulate(lead)
        source = np.maximum.accumulate(np.where(lead == best, steps, 0))
        cost, start = (best + steps).astype(np.int32), origin[source]
        if cost.min() > budget:
            return None
    end = int(np.argmin(cost))
    return (int(cost[end]), int(start[end]), end) if cost[end] <= budget else None


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 window: int | None = None) -> DataFrame:
    """One row per document and place of a benchmark item (start and length in the plain text).

    With ``window``, also of every passage of so many characters of a longer
    item: ``window_start`` and ``window_chars`` tell which (the whole item: 0
    and ``item_chars``).

    The items are the stated query set: they are searched for in blocks of
    about ``BLOCK_CHARS`` characters, one pass over all documents each.  Null
    and empty texts and items match nothing; a null doc_id is carried;
    repeated rows give repeated finds, repeated items one row per item; empty
    tables give no rows; other columns are not read.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").alias("text"))
    items = items.filter("text IS NOT NULL")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n_blocks = max(1, -(-total // BLOCK_CHARS))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).filter(
        "text IS NOT NULL")
    out = None
    for k in range(n_blocks):
        block = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == k)
        held = spark.sparkContext.broadcast([tuple(r) for r in block.orderBy("item_id", "text").collect()])

        def run(batches, held=held, name=uuid.uuid4().hex):
            known = worker_state().__dict__.setdefault("qgram_indexes", {})   # one index a worker, not one a task
            if name not in known:
                known.clear()
                known[name] = Index(held.value, window)
            index = known[name]
            for b in batches:
                ids, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
                ends = np.cumsum([len(t) for t in texts]) // TEXT_CHARS
                for lo, hi in pairwise([*np.flatnonzero(np.diff(ends, prepend=-1)), len(ids)]):
                    found = [(d, *r) for d, rows in zip(ids[lo:hi], index.find_all(texts[lo:hi])) for r in rows]
                    if found:
                        cols = list(zip(*found))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, t) for c, t in zip(cols, [pa.int64()] * 4 + [pa.int32()] * 5)], names=_NAMES)
        part = rows.mapInArrow(run, _SCHEMA)
        out = part if out is None else out.unionAll(part)
    return out
