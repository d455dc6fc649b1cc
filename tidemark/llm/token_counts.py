"""Operator 10 - token counts by finite-state tokenizer compilation.

Two deterministic machines are compiled from a public byte-level BPE file.

*Splitter.*  The pre-tokenizer pattern becomes a DFA over character classes
whose transitions say where a piece begins (before this character, before the
previous one).  The functions that character strings induce on its states form
a small monoid, which is enumerated together with its product table.  A text
is cut into chunks; every chunk's state map is one monoid element (found for
all chunks at once, one table step per position), the maps compose through a
parallel prefix scan with the product table, and a second sweep from the now
known start states emits the piece boundaries.

*Counter.*  Inside a piece a transducer over bytes annotates each transition
with the change of the number of emitted tokens.  A state holds, for every
suffix of the read bytes that begins some token, the last token of the
encoding before that suffix and its token count relative to now; reading a byte
selects the only token that ends here and may follow its predecessor (a pair
may follow each other if merging their bytes gives back the pair).  States
that agree behave alike whatever was read before, so the machine is finite; its
states are compiled on first use in each worker and kept within a bound.

Defined results: null is the empty text (0 bytes, 0 tokens); the file's added
tokens inside texts count one token each and split the text, as the library
does by default; very long texts are cut at places that are always piece
boundaries; repeated rows and other columns do not matter; an empty table
gives an empty result.
"""

from __future__ import annotations

import json
import os
import unicodedata

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, prepare

TOKENIZER = "byte_bpe_50k.json"
LIMIT = 512
CHUNK = 256
#: Characters handled at a time.
BLOCK_CHARS = 1 << 20
#: Cells of a worker's compiled transition table (4 bytes each) and entries of its
#: pair table, before they are dropped and compiled anew.
MAX_CELLS = 32_000_000
MAX_PAIRS = 800_000
#: Pieces longer than this are walked one at a time.
LONG_PIECE = 256

# Fixed values of the pattern
#   's|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+
_WHITE = "\t\n\x0b\x0c\r \x85\xa0                　"
_CLASSES = ["blank", "white", "letter", "number", "other", "quote", "end", "e", "l", "r", "v", "stmd"]
_C = {n: i for i, n in enumerate(_CLASSES)}
_LETTERS = {"letter", "e", "l", "r", "v", "stmd"}
# states: what the piece that holds the last character is
_STATES = ["start", "L", "N", "O", "blank1", "blank+", "white1", "white+", "quote", "q-r", "q-v", "q-l", "done"]


def _class_table() -> np.ndarray:
    t = np.full(0x110000, _C["other"], np.uint8)
    for c in range(0x110000):
        k = unicodedata.category(chr(c))[0]
        if k == "L":
            t[c] = _C["letter"]
        elif k == "N":
            t[c] = _C["number"]
    for ch in _WHITE:
        t[ord(ch)] = _C["white"]
    t[ord(" ")] = _C["blank"]
    t[ord("'")] = _C["quote"]
    for ch in "elrv":
        t[ord(ch)] = _C[ch]
    for ch in "stmd":
        t[ord(ch)] = _C["stmd"]
    return t


def _step(state: str, c: str) -> tuple[str, bool, bool]:
    """(next state, a piece begins before this character, one begins before the previous)."""
    if c == "end":  # a virtual character between texts
        return "start", True, state in ("q-r", "q-v", "q-l")
    if state in ("q-r", "q-v", "q-l"):
        if (state, c) in (("q-r", "e"), ("q-v", "e"), ("q-l", "l")):
            return "done", False, False
        nxt, here, _ = _step("L", c)  # not a contraction: the letter began a piece
        return nxt, here, True
    if state == "quote":
        if c == "stmd":
            return "done", False, False
        if c in ("r", "v", "l"):
            return f"q-{c}", False, False
        if c in ("other", "quote"):
            return "O", False, False
        return _step("done", c)
    if c in ("blank", "white"):
        inside = state in ("blank1", "blank+", "white1", "white+")
        return f"{c}{'+' if inside else '1'}", not inside, False
    before = state in ("blank+", "white+")  # the last white character leaves its run
    joined = state in ("blank1", "blank+")  # a blank joins what follows
    kind = "L" if c in _LETTERS else "N" if c == "number" else "O"
    if c == "quote" and state != "O" and not joined:
        return "quote", True, before
    return kind, not joined and state != kind, before


class Splitter:
    """The pattern as tables; ``pieces`` finds the piece starts of many texts at once."""

    def __init__(self):
        n, k = len(_STATES), len(_CLASSES)
        idx = {s: i for i, s in enumerate(_STATES)}
        self.next = np.zeros((n, k), np.uint8)
        self.emit = np.zeros((n, k), np.uint8)
        for s in _STATES:
            for c in _CLASSES:
                t, here, prev = _step(s, c)
                self.next[idx[s], _C[c]] = idx[t]
                self.emit[idx[s], _C[c]] = here + 2 * prev
        # the monoid of state maps: generators are the classes, element 0 the identity
        gens = [tuple(int(x) for x in self.next[:, j]) for j in range(k)]
        elems, num, grow = [tuple(range(n))], {tuple(range(n)): 0}, []
        at = 0
        while at < len(elems):
            row = []
            for g in gens:
                m = tuple(g[x] for x in elems[at])
                if m not in num:
                    num[m] = len(elems)
                    elems.append(m)
                row.append(num[m])
            grow.append(row)
            at += 1
        self.grow = np.array(grow, np.int32)           # element x class -> element
        self.maps = np.array(elems, np.uint8)          # element x state -> state
        product = np.empty((len(elems), len(elems)), np.int32)
        for i, a in enumerate(elems):
            for j, b in enumerate(elems):
                product[i, j] = num[tuple(b[x] for x in a)]
        self.product = product                         # first i, then j
        self.classes = _class_table()

    def scan(self, maps: np.ndarray) -> np.ndarray:
        """Inclusive prefix products of state maps in log2(n) rounds."""
        out, d = maps.copy(), 1
        while d < len(out):
            out[d:] = self.product[out[:-d], out[d:]]
            d *= 2
        return out

    def pieces(self, cls: np.ndarray) -> np.ndarray:
        """Positions (of the class string) at which a piece begins; the virtual
        ``end`` characters between texts begin one too."""
        n = len(cls)
        if not n:
            return np.empty(0, np.int64)
        chunks = -(-n // CHUNK)
        grid = np.full(chunks * CHUNK, _C["end"], np.uint8)
        grid[:n] = cls
        grid = np.ascontiguousarray(grid.reshape(chunks, CHUNK).T)
        k, grow, nxt, emit = len(_CLASSES), self.grow.ravel(), self.next.astype(np.int32).ravel(), self.emit.ravel()
        m = np.zeros(chunks, np.int32)
        for row in grid:
            m = grow[m * k + row]
        state = np.zeros(chunks, np.int32)
        state[1:] = self.maps[self.scan(m)[:-1], 0]
        out = np.empty((CHUNK, chunks), np.uint8)
        for j, row in enumerate(grid):
            at = state * k + row
            out[j] = emit[at]
            state = nxt[at]
        flags = out.T.ravel()[:n]
        begins = (flags & 1).astype(bool)
        begins[:-1] |= (flags[1:] & 2).astype(bool)
        return np.flatnonzero(begins)


def _byte_chars() -> dict[str, int]:
    """The printable characters that stand for bytes in the file."""
    direct = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(direct)]
    return {chr(b): b for b in direct} | {chr(256 + i): b for i, b in enumerate(rest)}


class Counter:
    """The byte transducer of one BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre, model = spec["pre_tokenizer"], spec["model"]
        if (pre or {}).get("type") != "ByteLevel" or pre.get("add_prefix_space") or spec.get("normalizer") \
                or model.get("ignore_merges"):
            raise ValueError("a plain byte-level BPE file is needed")
        self.added = [t["content"] for t in spec.get("added_tokens", [])]
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec.get("added_tokens", [])):
            raise ValueError("added tokens that strip or match words are not supported")
        back = _byte_chars()
        raw = lambda s: bytes(back[c] for c in s)
        self.bytes = {i: raw(t) for t, i in model["vocab"].items() if t not in self.added}
        ids = {b: i for i, b in self.bytes.items()}
        self.ids = ids
        self.rank = {}
        for r, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.rank[ids[raw(a)], ids[raw(b)]] = (r, ids[raw(a) + raw(b)])
        self.trie, self.token, self.size = {}, [-1], 1
        for b, i in ids.items():
            node = 0
            for x in b:
                nxt = self.trie.get(node << 8 | x)
                if nxt is None:
                    nxt = self.trie[node << 8 | x] = self.size
                    self.token.append(-1)
                    self.size += 1
                node = nxt
            self.token[node] = i
        self.inner = bytearray(self.size)  # nodes that some token goes on from
        for key in self.trie:
            self.inner[key >> 8] = 1
        self.follow: dict = {}
        self.width = 128
        self.column = np.full(256, -1, np.int32)  # byte -> column, given on first sight
        self.byte_of: list[int] = []
        self._reset()

    def _reset(self):
        # an entry packs (trie node of a suffix, last token before it, its count less the
        # count now); entries whose node ends its branch are left out
        start = (self._pack(0, -1, 0),)
        self.state = {start: 0}
        self.entries = [start]
        # state x column -> next state << 8 | gain + 128, or -1 where not compiled yet
        self.table = np.full(1024 * self.width, -1, np.int32)

    def columns(self, data: np.ndarray) -> np.ndarray:
        new = np.flatnonzero((np.bincount(data, minlength=256) > 0) & (self.column < 0))
        for byte in new.tolist():
            self.column[byte] = len(self.byte_of)
            self.byte_of.append(byte)
        if len(self.byte_of) > self.width:
            self.width = 256
            self._reset()
        return self.column[data]

    def merged(self, data: bytes) -> list[int]:
        """Plain merge loop; used only on one or two tokens' bytes while compiling."""
        seq = [self.ids[bytes([x])] for x in data]
        while len(seq) > 1:
            best = min((self.rank.get(p, (1 << 60, -1)) for p in zip(seq, seq[1:])))
            if best[1] < 0:
                break
            out, i = [], 0
            while i < len(seq):
                if i + 1 < len(seq) and self.rank.get((seq[i], seq[i + 1])) == best:
                    out.append(best[1])
                    i += 2
                else:
                    out.append(seq[i])
                    i += 1
            seq = out
        return seq

    def may_follow(self, last: int, token: int) -> bool:
        key = (last, token)
        ok = self.follow.get(key)
        if ok is None:
            if last < 0:
                ok = self.merged(self.bytes[token]) == [token]
            else:
                ok = self.merged(self.bytes[last] + self.bytes[token]) == [last, token]
            if len(self.follow) > MAX_PAIRS:
                self.follow.clear()
            self.follow[key] = ok
        return ok

    @staticmethod
    def _pack(node: int, last: int, rel: int) -> int:
        return node << 40 | (last + 1) << 12 | rel + 2048

    def compile_arc(self, state: int, byte: int) -> int:
        live, gain = [], None
        trie, tokens, inner = self.trie, self.token, self.inner
        for e in self.entries[state]:
            nxt = trie.get((e >> 40) << 8 | byte)
            if nxt is None:
                continue
            if inner[nxt]:
                live.append(nxt << 40 | e & 0xFFFFFFFFFF)
            if gain is None and tokens[nxt] >= 0 and self.may_follow((e >> 12 & 0xFFFFFFF) - 1, tokens[nxt]):
                token, gain = tokens[nxt], (e & 4095) - 2048 + 1
        # single bytes are tokens, so one always ends here
        key = (*(e - gain for e in live), self._pack(0, token, 0))
        to = self.state.get(key)
        if to is None:
            to = self.state[key] = len(self.entries)
            self.entries.append(key)
            if (to + 1) * self.width > len(self.table):
                self.table = np.concatenate((self.table, np.full(len(self.table), -1, np.int32)))
        arc = to << 8 | gain + 128
        self.table[state * self.width + self.column[byte]] = arc
        return arc

    def counts(self, data: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Tokens of the pieces data[at:at+size], all walked together byte by byte."""
        if len(self.entries) * self.width > MAX_CELLS:
            self._reset()
        cols = self.columns(data)
        out = np.zeros(len(at), np.int64)
        order = np.argsort(np.minimum(size, 0xFFFF).astype(np.uint16), kind="stable")[::-1]
        long = int((size > LONG_PIECE).sum())
        for i in order[:long].tolist():
            out[i] = self._walk(cols[at[i]:at[i] + size[i]])
        order = order[long:]
        pos, state, n = at[order], np.zeros(len(order), np.int32), np.zeros(len(order), np.int64)
        alive = len(order) - np.cumsum(np.bincount(size[order], minlength=1))  # pieces longer than j
        for j, k in enumerate(alive.tolist()):
            if k <= 0:
                break
            cell = state[:k] * self.width + cols[pos[:k] + j]
            arc = self.table[cell]
            miss = np.flatnonzero(arc < 0)
            if len(miss):
                for c in np.unique(cell[miss]).tolist():
                    self.compile_arc(c // self.width, self.byte_of[c % self.width])
                arc[miss] = self.table[cell[miss]]
            state[:k] = arc >> 8
            n[:k] += (arc & 255) - 128
        out[order] = n
        return out

    def _walk(self, cols: np.ndarray) -> int:
        state, n = 0, 0
        for c in cols.tolist():
            arc = int(self.table[state * self.width + c])
            if arc < 0:
                arc = self.compile_arc(state, self.byte_of[c])
            state = arc >> 8
            n += (arc & 255) - 128
        return n


class Tokenizer:
    def __init__(self, path: str):
        self.splitter, self.counter = Splitter(), Counter(path)

    def _segments(self, text: str) -> tuple[list[str], int]:
        """Parts that are split on their own, and the number of added tokens between them."""
        parts, added = [text], 0
        for a in self.counter.added:
            cut = [p.split(a) for p in parts]
            added += sum(len(c) - 1 for c in cut)
            parts = [x for c in cut for x in c]
        out = []
        for p in parts:
            while len(p) > BLOCK_CHARS:
                at = BLOCK_CHARS // 2
                while True:  # a lone blank between other characters always begins a piece
                    at = p.find(" ", at)
                    if at < 0 or at + 1 >= len(p) or not (p[at - 1].isspace() or p[at + 1].isspace()):
                        break
                    at += 1
                if at < 0 or at + 1 >= len(p):
                    break
                out.append(p[:at])
                p = p[at:]
            out.append(p)
        return out, added

    def _block(self, parts: list[str]) -> np.ndarray:
        """Tokens of each part."""
        text = "\0".join(parts) + "\0"
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        cls = self.splitter.classes[points]
        ends = np.cumsum([len(p) + 1 for p in parts]) - 1
        cls[ends] = _C["end"]
        starts = self.splitter.pieces(cls)
        data = np.frombuffer(text.encode("utf-8"), np.uint8)
        where = starts
        if len(data) > len(points):  # character to byte positions
            width = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
            where = (np.cumsum(width) - width)[starts]
        size = np.diff(np.append(where, len(data)))
        marks = np.searchsorted(starts, ends)  # an end mark is a piece without tokens
        size[marks] = 0
        total = np.cumsum(self.counter.counts(data, where, size))[marks]
        return np.diff(np.concatenate(([0], total)))

    def counts(self, texts) -> np.ndarray:
        out = np.zeros(len(texts), np.int64)
        parts, owner, held = [], [], 0

        def flush():
            if parts:
                np.add.at(out, owner, self._block(parts))

        for i, t in enumerate(texts):
            if not t:
                continue
            segs, added = self._segments(t)
            out[i] += added
            for s in segs:
                parts.append(s)
                owner.append(i)
                held += len(s)
                if held >= BLOCK_CHARS:
                    flush()
                    parts, owner, held = [], [], 0
        flush()
        return out


_LOADED: dict[str, Tokenizer] = {}


def tokenizer(name: str) -> Tokenizer:
    """One per Python worker.  ``name`` is a path, or a file of the public vocabularies."""
    if name not in _LOADED:
        path = name
        if not os.path.isabs(name):
            import public_tokenizers

            path = public_tokenizers.path(name)
        _LOADED[name] = Tokenizer(path)
    return _LOADED[name]


def token_count_udf(name: str = TOKENIZER):
    @F.pandas_udf("long")
    def n_tokens(texts: pd.Series) -> pd.Series:
        return pd.Series(tokenizer(name).counts(texts.tolist()))

    return n_tokens


def token_counts(docs: DataFrame, name: str = TOKENIZER, limit: int = LIMIT) -> DataFrame:
    prepare(docs.sparkSession)
    n = docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
                    token_count_udf(name)("text").alias("n_tokens"))
    return n.withColumn("over_limit", F.col("n_tokens") > limit)


def op10_token_counts(spark, sf_dir):
    return token_counts(documents(spark, sf_dir))
