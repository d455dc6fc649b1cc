"""Operator 6 - benchmark decontamination under word edit distance.

A document is contaminated by an item of n words if some window of its words
is within floor(``max_edits`` * n) word edits of the item (words are compared
without case and punctuation).

* **Windows.**  Items are grouped by size; a group of sizes a..b looks at
  windows of b words (plus the allowed edits) from every word of the text.  A
  window within k edits of an item of n words shares at least n - 1 - 2k of
  its word pairs, so windows with fewer benchmark pairs of their size group are
  left out (a lossless filter, by running sums).
* **Embedding.**  The CGK random walk reads the window's current word, writes
  it, and moves on by a random bit of (step, word): edit distance becomes
  Hamming distance of the written strings.  Items are embedded alike.
* **LSH.**  At most ``sampled`` written symbols make a key; several walks with
  fresh bits and samples are made, some sampled early in the walk and some
  over all of it (every edit shifts the walks against each other, so late
  symbols of long items agree less).  Each size group takes the most symbols a
  key and the fewest walks that find ``recall`` of planted copies with the
  group's allowed number of missing, added or replaced words (``key_plan``).
* **Verification.**  Windows that share a key with an item are checked by the
  exact edit distance to the item, free at the window's end; the best window
  of each (document, item) is returned.

The benchmark is read in blocks of at most ``block_bytes`` of text; a block is
broadcast and every document is searched for it, so nothing larger than a
block is ever held.

Defined results: null, empty and wordless texts hold nothing; items of fewer
than ``MIN_WORDS`` words identify nothing and are left out (so are null items);
repeated documents are reported as often as they occur; items with equal texts
are all reported; with an empty benchmark or table there are no hits; other
columns are not read and survive ``uncontaminated``.
"""

from __future__ import annotations

import math
import re
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, prepare

MAX_EDITS = 0.2
MIN_WORDS = 5
SAMPLED = 3
RECALL = 0.99
AGREEMENT = 0.5
BLOCK_BYTES = 8 << 20
#: Planted copies per kind of edit by which a size group's keys are chosen.
TRIALS = 400
#: Words handled at a time in a worker.
BATCH_WORDS = 1 << 19
PAIR_BITS = 22
_DELETED = bytes(b for b in range(128) if not chr(b).isalnum() and b not in b" \t\n\x0b\x0c\r")
_ODD = re.compile(r"[^\w\x00-\x7f]+")


def repetitions(recall: float = RECALL, agreement: float = AGREEMENT, sampled: int = SAMPLED) -> int:
    return math.ceil(math.log(1 - recall) / math.log(1 - agreement ** sampled))


def normal_words(text: str) -> list[bytes]:
    """Words (between ASCII white space) without case, punctuation and other
    characters that are neither letter nor digit; words left empty vanish."""
    if text.isascii():
        raw = text.encode().lower()
    else:
        text = text.casefold()
        if _ODD.search(text):
            text = _ODD.sub("", text)
        raw = text.encode("utf-8", "surrogatepass")
    return raw.translate(None, _DELETED).split()


def allowed(n, max_edits: float = MAX_EDITS):
    return np.floor(np.asarray(n) * max_edits + 1e-9).astype(np.int64)


def prefix_distances(windows: np.ndarray, items: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row-wise smallest word edit distance of an item to any prefix of its
    window, and the length of the shortest such prefix."""
    rows, m = windows.shape
    cols = np.arange(m + 1, dtype=np.int16)
    d = np.broadcast_to(cols, (rows, m + 1)).copy()
    for i in range(items.shape[1]):
        t = np.empty_like(d)
        t[:, 0] = i + 1
        np.minimum(d[:, 1:] + 1, d[:, :-1] + (windows != items[:, i:i + 1]), out=t[:, 1:])
        t -= cols
        d = np.minimum.accumulate(t, axis=1) + cols
    end = d.argmin(axis=1)
    return d[np.arange(rows), end], end


def planted(rng, n: int, edits: int, kind: str, width: int) -> np.ndarray:
    """TRIALS windows (rows of ``width`` words) on copies of an item of the words
    1..n with random edits, from the first word that is left of the item."""
    out = np.zeros((TRIALS, width), np.int32)  # 0: words no item has
    for row in out:
        at = rng.choice(n, min(edits, n - 1), replace=False)
        x = np.arange(1, n + 1)
        if kind == "missing":
            x = np.delete(x, at)
        elif kind == "replaced":
            x[at] = 0
        else:
            x = np.insert(x, rng.integers(1, n, edits), 0)
        x = x[np.flatnonzero(x)[0]:][:width]
        row[:len(x)] = x
    return out


def agreements(windows: np.ndarray, n: int, mul: np.ndarray, add: np.ndarray) -> np.ndarray:
    """(walks x windows x steps): does the walk write the same over the item 1..n and the window?"""
    rows, m = windows.shape
    item = np.full((1, m), -1, np.int32)
    item[0, :n] = np.arange(1, n + 1)
    same = np.zeros((len(mul), rows, mul.shape[1]), bool)
    both = [[np.broadcast_to(x, (rows, m)).ravel().astype(np.int64) + 2, np.zeros((len(mul), rows), np.int64)]
            for x in (item, windows)]
    base = np.arange(rows) * m
    for j in range(mul.shape[1]):
        written = []
        for side in both:
            flat, pos = side
            sym = flat[base + np.minimum(pos, m - 1)]
            sym[pos >= m] = 1
            written.append(sym)
            side[1] = pos + ((sym * mul[:, j, None] + add[:, j, None]) >> 40 & 1)
        same[:, :, j] = written[0] == written[1]
    return same


def key_plan(rng, sizes, max_edits: float = MAX_EDITS, sampled: int = SAMPLED, recall: float = RECALL,
             agreement: float = AGREEMENT) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """(sampled steps per walk, mul, add, worst share found) for a group of items of ``sizes`` words."""
    a, b = int(min(sizes)), int(max(sizes))
    steps = 2 * a
    first = repetitions(recall, agreement, sampled)
    mul = rng.integers(1, 1 << 62, (8 * first, steps)) | 1
    add = rng.integers(0, 1 << 62, (8 * first, steps))
    cases = [(planted(rng, n, int(allowed(n, max_edits)), kind, b + int(allowed(b, max_edits))), n)
             for n in sorted({a, b}) for kind in ("missing", "added", "replaced")]
    best = None
    for take in range(min(sampled, steps), 0, -1):
        # walk r samples the first steps >> (r mod levels) steps: all of the walk, half of it, ...
        levels = max(1, int(math.log2(steps / (2 * take))) + 1)
        at = np.sort(np.array([rng.choice(steps >> r % levels, take, replace=False) for r in range(len(mul))]), axis=1)
        found = [np.zeros(TRIALS, bool) for _ in cases]
        lo = 0
        for hi in (first, 2 * first, 4 * first, 8 * first):
            for c, (windows, n) in enumerate(cases):
                left = np.flatnonzero(~found[c])
                if len(left):
                    same = agreements(windows[left], n, mul[lo:hi], add[lo:hi])
                    hit = np.take_along_axis(same, at[lo:hi, None, :].repeat(len(left), 1), axis=2).all(axis=2)
                    found[c][left[hit.any(axis=0)]] = True
            lo = hi
            worst = min(f.mean() for f in found)
            if best is None or worst > best[3]:
                best = at[:hi], mul[:hi], add[:hi], float(worst)
            if worst >= recall:
                return at[:hi], mul[:hi], add[:hi], float(worst)
    return best


class Index:
    """Items of one benchmark block, embedded and keyed."""

    def __init__(self, items: list[tuple[int, str]], max_edits: float = MAX_EDITS, sampled: int = SAMPLED,
                 recall: float = RECALL, agreement: float = AGREEMENT, seed: int = 6):
        self.vocabulary: dict[bytes, int] = {}
        self.item_ids, self.words = [], []
        for item_id, text in items:
            w = normal_words(text or "")
            if len(w) >= MIN_WORDS:
                self.item_ids.append(item_id)
                self.words.append(np.array([self.vocabulary.setdefault(x, len(self.vocabulary) + 1) for x in w], np.int32))
        sizes = np.array([len(w) for w in self.words], np.int64)
        self.edits = allowed(sizes, max_edits)
        # size groups with a ratio of at most 1.25
        self.groups = []
        rng = np.random.default_rng(seed)
        left = np.unique(sizes)
        self.pair_groups = np.zeros(1 << PAIR_BITS, np.uint32)
        self.first_groups = np.zeros(len(self.vocabulary) + 1, np.uint32)
        self.mult = np.uint64(0x9E3779B97F4A7C15)
        while len(left):
            a = int(left[0])
            b = int(left[left <= max(a, a * 1.25)][-1])
            left = left[left > b]
            own = np.flatnonzero((sizes >= a) & (sizes <= b))
            g = min(len(self.groups), 31)  # beyond 32 groups the last bit is shared (the filter only gets looser)
            for i in own:
                self.pair_groups[self.pair_slot(self.words[i][:-1], self.words[i][1:])] |= np.uint32(1 << g)
                self.first_groups[self.words[i][:self.edits[i] + 1]] |= np.uint32(1 << g)
            at, mul, add, _ = key_plan(rng, sizes[own], max_edits, sampled, recall, agreement)
            group = {
                "bit": g, "window": b + int(self.edits[own].max()), "items": own,
                "need": int((sizes[own] - 1 - 2 * self.edits[own]).min()),
                "at": at, "mul": mul, "add": add,
            }
            padded = np.full((len(own), group["window"]), -1, np.int32)
            for r, i in enumerate(own):
                padded[r, :sizes[i]] = self.words[i]
            keys = self.embed(group, padded)
            group["order"] = np.argsort(keys, axis=1, kind="stable")
            group["keys"] = np.take_along_axis(keys, group["order"], axis=1)
            self.groups.append(group)

    def pair_slot(self, a, b):
        h = (a.astype(np.uint64) * np.uint64(0x100000001) + b.astype(np.uint64) + np.uint64(1)) * self.mult
        return (h >> np.uint64(64 - PAIR_BITS)).astype(np.int64)

    @staticmethod
    def embed(group: dict, windows: np.ndarray) -> np.ndarray:
        """(repetitions x rows) keys of sampled symbols of the random walks."""
        rows, m = windows.shape
        flat, base = windows.ravel().astype(np.int64) + 2, np.arange(rows) * m
        at = group["at"]
        reps = len(at)
        pos = np.zeros((reps, rows), np.int64)
        key = np.repeat(np.arange(1, reps + 1, dtype=np.uint64)[:, None], rows, axis=1)
        for j in range(int(at[:, -1].max()) + 1):
            sym = flat[base + np.minimum(pos, m - 1)]
            sym[pos >= m] = 1
            now = np.flatnonzero((at == j).any(axis=1))
            if len(now):
                k = (key[now] ^ sym[now].astype(np.uint64)) * np.uint64(0xD6E8FEB86659FD93)
                key[now] = k ^ (k >> np.uint64(32))
            pos += (sym * group["mul"][:, j, None] + group["add"][:, j, None]) >> 40 & 1
        return key

    def symbols(self, text: str) -> list[int]:
        """Item word numbers of a text's words; 0: a word no item has."""
        return list(map(self.vocabulary.get, normal_words(text), repeat(0)))

    def search(self, texts) -> list[list[tuple]]:
        """Per text its hits (item_id, first word, end word, distance), one per item."""
        hits: list[list[tuple]] = [[] for _ in texts]
        held, owner, total = [], [], 0
        for i, t in enumerate(texts):
            if not t or not self.words:
                continue
            s = np.array(self.symbols(t), np.int32)
            if len(s) < MIN_WORDS - 1:
                continue
            held.append(s)
            owner.append(i)
            total += len(s)
            if total >= BATCH_WORDS:
                self._search(held, owner, hits)
                held, owner, total = [], [], 0
        if held:
            self._search(held, owner, hits)
        return hits

    def _search(self, held, owner, hits):
        gap = np.full(max(g["window"] for g in self.groups) + 1, -1, np.int32)
        s = np.concatenate([x for h in held for x in (h, gap)])
        begins = np.cumsum([0] + [len(h) + len(gap) for h in held[:-1]])
        known = (s[:-1] > 0) & (s[1:] > 0)
        at = np.flatnonzero(known)
        mask = np.zeros(len(s), np.uint32)
        mask[at] = self.pair_groups[self.pair_slot(s[at], s[at + 1])]
        firsts = np.where(s > 0, self.first_groups[np.maximum(s, 0)], np.uint32(0))
        best: dict[tuple, tuple] = {}
        for g in self.groups:
            run = np.concatenate(([0], np.cumsum(mask >> np.uint32(g["bit"]) & np.uint32(1), dtype=np.int64)))
            w = g["window"]
            n = len(s) - w
            live = np.flatnonzero((run[w - 1:w - 1 + n] - run[:n] >= max(g["need"], 1))
                                  & (firsts[:n] >> np.uint32(g["bit"]) & np.uint32(1)).astype(bool))
            for lo in range(0, len(live), 2048):
                self._verify(g, s, live[lo:lo + 2048], begins, best)
        for (doc, item), (dist, start, end) in best.items():
            hits[owner[doc]].append((self.item_ids[item], start, end, dist))

    def _verify(self, g, s, starts, begins, best):
        windows = s[starts[:, None] + np.arange(g["window"])]
        ended = np.maximum.accumulate(windows < 0, axis=1)
        windows = np.where(ended, -1, windows)
        keys = self.embed(g, windows)
        pairs = []
        for r in range(len(keys)):
            lo, hi = np.searchsorted(g["keys"][r], keys[r], "left"), np.searchsorted(g["keys"][r], keys[r], "right")
            got = np.flatnonzero(hi > lo)
            if len(got):
                n = (hi - lo)[got]
                which = np.repeat(lo[got] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
                pairs.append(np.repeat(got, n) * len(g["items"]) + g["order"][r][which])
        if not pairs:
            return
        pairs = np.unique(np.concatenate(pairs))
        rows, local = pairs // len(g["items"]), pairs % len(g["items"])
        for k in np.unique(local):
            item = int(g["items"][k])
            own, words, bound = rows[local == k], self.words[item], int(self.edits[item])
            part = windows[own, :len(words) + bound]
            # a position in the gap must cost an edit and never help
            dist, end = prefix_distances(part, np.broadcast_to(words, (len(own), len(words))))
            for x in np.flatnonzero(dist <= bound).tolist():
                at = int(starts[own[x]])
                doc = int(np.searchsorted(begins, at, "right")) - 1
                first = at - int(begins[doc])
                found = (int(dist[x]), first, first + int(end[x]))
                if (doc, item) not in best or found < best[doc, item]:
                    best[doc, item] = found


HITS = "array<struct<item_id:long,first_word:int,end_word:int,distance:int>>"


def hits_udf(spark, items: list[tuple[int, str]]):
    """Hits of one block of items; the index is built once and broadcast."""
    index = spark.sparkContext.broadcast(Index(items))

    @F.pandas_udf(HITS)
    def hits(texts: pd.Series) -> pd.Series:
        found = index.value.search(texts.tolist())
        return pd.Series([[{"item_id": i, "first_word": a, "end_word": b, "distance": d} for i, a, b, d in sorted(h)]
                          for h in found])

    return hits


def benchmark_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES):
    """Yield lists of (item_id, text) of at most about ``block_bytes`` each."""
    total = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = int(total // block_bytes) + 1
    b = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    for i in range(blocks):
        yield [(r[0], r[1]) for r in benchmark.filter(F.col("text").isNotNull() & (b == i)).select("item_id", "text").collect()]


def leaks(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, item_id, first_word, end_word, distance): one row per document and item found in it."""
    spark = prepare(docs.sparkSession)
    out = None
    for items in benchmark_blocks(benchmark, block_bytes):
        part = docs.select("doc_id", F.explode(hits_udf(spark, items)("text")).alias("h")).select("doc_id", "h.*")
        out = part if out is None else out.unionByName(part)
    return out


def uncontaminated(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` without any hit, all columns kept."""
    spark = prepare(docs.sparkSession)
    rows = docs
    for items in benchmark_blocks(benchmark, block_bytes):
        rows = rows.filter(F.size(hits_udf(spark, items)("text")) == 0)
    return rows


def op6_decontamination(spark, sf_dir):
    return leaks(documents(spark, sf_dir).select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
