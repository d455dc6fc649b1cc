"""Operator 8 - Katz backoff language model with Good-Turing discounts.

Tokens are the lower-cased (A-Z) words of a text and one end; a word's context
is the word before it, or the start.  With c the training counts:

* P(w) = d_c c / N for seen tokens, and the mass the discounts leave for one
  unknown token;
* P(w | v) = d_c c / c(v) for all counted pairs (times a context's factor, 1
  unless the context would keep nothing for other words), else a(v) P(w), where a(v) = (1 - sum of kept P(. | v)) /
  (1 - sum of P over the same words): every context sums to one exactly.

d_c is the Good-Turing discount of counts up to ``KNOWN``, separately for words
and pairs, from the counts of counts of all training texts.

How it runs.  Each task turns its texts into the n-grams (none, w) and (v, w),
grouped: per bucket one packed blob of the different n-grams, their training
counts, and which texts hold them how often.  A word's own count and all pairs
it begins share a bucket (hash of the word).  The blobs are shuffled once.  Per
bucket the counts are added up: the tables of words and pairs.  Spark joins the
pairs with the counts of their second words (those of the ``COMMON`` words are
broadcast) and sends them back to their buckets, where a context's sums, its backoff weight and the n-grams' values are
local; the n-grams of the same (already shuffled) blobs look them up, and each
text gets the sum of its values (added up per chunk, one blob a bucket):

  log P(text) = a(start) + sum over tokens (log a(token) + log P(token))
              + sum over kept pairs (log P(w | v) - log a(v) - log P(w)).

Words are told apart by 64-bit hashes.  The ``COMMON`` most frequent words of a
sample get short numbers instead (smaller blobs, nothing else).  The start and
the first ``HOT`` of them are dealt over ``SALTS`` buckets: pairs by their
second word, the words themselves and pairs of the first ``TOP`` by chunk, so
that no bucket holds a hot context or all texts of a hot pair; the sums of
these contexts (at most HOT rows) are added up by Spark and broadcast.  Nothing
else of the corpus passes the driver but counts of counts and totals.

Defined results: null is the empty text (one token, the end); equal texts have
equal scores and count as often as they occur; without training texts every
score is the base score's uniform form (P = 1); ties do not arise; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import partial
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, documents, prepare, releasing, shuffle_width, staged, word_spans

HELD_OUT = (5, 1)
MIN_PAIR = 1  # every counted pair is in the tables
KNOWN = 5
COMMON = 200_000
SAMPLE = 8192
HOT = 1024
TOP = 64
SALTS = 32
CHUNK_TOKENS = 1_000_000
#: Bytes of all texts per bucket: a bucket's n-grams are counted in one task's memory.
BUCKET_BYTES = 8 << 20
#: N-grams of a bucket added up at a time.
MERGE_ROWS = 1 << 20
VALUE_ROWS = 1 << 16
NONE, START, END = 0, 1, 2  # reserved token numbers
_MARK = np.uint64(1 << 63)


def word_hash(w: bytes) -> int:
    return xxhash.xxh64_intdigest(w, 42)


def mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One 64-bit hash of two token numbers."""
    with np.errstate(over="ignore"):
        h = (a * np.uint64(0x9E3779B97F4A7C15)) ^ (b + np.uint64(0xD6E8FEB86659FD93))
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
        h *= np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(29))


def is_shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """N-grams whose texts are dealt by chunk, so that counts meet only in Spark."""
    hot, top = np.uint64(END + HOT), np.uint64(END + TOP)
    return np.where(a == NONE, b <= hot, (a <= top) & (b <= top))


def places(a: np.ndarray, b: np.ndarray, chunk_salt: int, buckets: int) -> np.ndarray:
    """Bucket of each n-gram; ``chunk_salt`` counts only where ``is_shared``."""
    word = np.where(a == NONE, b, a)
    salt = np.where(word <= np.uint64(END + HOT), mixed(b, b) % np.uint64(SALTS), np.uint64(0))
    salt = np.where(is_shared(a, b), np.uint64(chunk_salt), salt)
    return (mixed(word, salt) % np.uint64(buckets)).astype(np.int32)


_CODEC = pa.Codec("zstd", 3)


def pack(*columns: np.ndarray) -> bytes:
    """Columns as one compressed blob (bytes of equal weight side by side, leading zeros left out)."""
    head, planes = [len(columns)], []
    for c in columns:
        width = c.dtype.itemsize
        if c.dtype.kind != "f":
            most = int(c.view(f"u{width}").max()) if len(c) else 0
            width = max(1, (most.bit_length() + 7) // 8)
        head += [width, len(c)]
        rows = np.ascontiguousarray(c).view(np.uint8).reshape(len(c), c.dtype.itemsize)
        planes.append(np.ascontiguousarray(rows[:, :width].T).tobytes())
    raw = np.array(head, "<i8").tobytes() + b"".join(planes)
    return len(raw).to_bytes(8, "little") + _CODEC.compress(raw, asbytes=True)


def unpack(blob: bytes, kinds: str) -> list[np.ndarray]:
    raw = _CODEC.decompress(memoryview(blob)[8:], int.from_bytes(blob[:8], "little"), asbytes=True)
    n = int(np.frombuffer(raw, "<i8", 1)[0])
    head = np.frombuffer(raw, "<i8", 2 * n, 8).reshape(n, 2)
    at, out = 8 + 16 * n, []
    for (width, length), kind in zip(head.tolist(), kinds.split()):
        rows = np.zeros((length, np.dtype(kind).itemsize), np.uint8)
        rows[:, :width] = np.frombuffer(raw, np.uint8, width * length, at).reshape(width, length).T
        out.append(rows.reshape(-1).view(kind))
        at += width * length
    return out


def steps(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted n-grams as differences: of first words, and of second words after the same first word."""
    da, db = a.copy(), b.copy()
    da[1:] -= a[:-1]
    again = np.flatnonzero(da[1:] == 0) + 1
    db[again] -= b[again - 1]
    return da, db


def stepped(da: np.ndarray, db: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of their ``steps``."""
    a, run = np.cumsum(da, dtype=np.uint64), np.cumsum(db, dtype=np.uint64)
    first = da != 0
    first[:1] = True
    start = np.flatnonzero(first)
    return a, run - np.repeat(run[start] - db[start], np.diff(np.append(start, len(a))))


def framed(first: bytes, second: bytes) -> bytes:
    """Two blobs as one; ``unframed`` reads either without the other."""
    return len(first).to_bytes(8, "little") + first + second


def unframed(blob: bytes) -> tuple[bytes, bytes]:
    n = int.from_bytes(blob[:8], "little") + 8
    return blob[8:n], blob[n:]


class Places:
    """``places`` for a chunk's codes, by tables over its dictionary."""

    def __init__(self, number: np.ndarray, chunk_salt: int, buckets: int):
        none = np.full(len(number), NONE, np.uint64)
        self.words = places(none, number, chunk_salt, buckets)
        self.cold = (mixed(number, none) % np.uint64(buckets)).astype(np.int32)
        self.salt = (mixed(number, number) % np.uint64(SALTS)).astype(np.int8)
        self.hot, self.top = number <= np.uint64(END + HOT), number <= np.uint64(END + TOP)
        self.row = np.cumsum(self.hot, dtype=np.int32) - 1
        own = number[self.hot]
        self.salted = (mixed(np.repeat(own, SALTS), np.tile(np.arange(SALTS, dtype=np.uint64), len(own)))
                       % np.uint64(buckets)).astype(np.int32).reshape(-1, SALTS)
        self.chunk_salt = chunk_salt

    def pairs(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = self.cold[a]
        i = np.flatnonzero(self.hot[a])
        a, b = a[i], b[i]
        salt = np.where(self.top[a] & self.top[b], np.int8(self.chunk_salt), self.salt[b])
        out[i] = self.salted[self.row[a], salt]
        return out


class Numbering:
    """Token numbers of words: small for common ones, a marked hash for others."""

    def __init__(self, common: list[int]):
        hashes = np.array(common, np.uint64)
        order = np.argsort(hashes)
        self.hashes, self.small = hashes[order], (order + END + 1).astype(np.uint64)

    def numbers(self, words: list[bytes]) -> np.ndarray:
        hashes = np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=42), words), np.uint64, len(words))
        out = hashes | _MARK
        if len(self.hashes):
            at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
            known = self.hashes[at] == hashes
            out[known] = self.small[at[known]]
        return out


def home_of(chunk: int, buckets: int) -> int:
    """Bucket that collects the sums of a chunk."""
    return int(mixed(np.array([chunk], np.uint64), np.array([NONE], np.uint64))[0] % np.uint64(buckets))


def in_order(place, before, after, doc, buckets: int, kinds: int, texts: int) -> tuple[np.ndarray, ...]:
    """The four columns sorted by all of them: as one number where they fit into 63 bits."""
    word, text = kinds.bit_length(), texts.bit_length()
    if buckets.bit_length() + 2 * word + text > 63:
        order = np.lexsort((doc, after, before, place))
        return place[order], before[order], after[order], doc[order]
    key = place.astype(np.int64)
    for column, bits in ((before, word), (after, word), (doc, text)):
        key <<= bits
        key |= column
    key.sort()
    low = (1 << word) - 1
    return ((key >> (2 * word + text)).astype(np.int32), ((key >> (word + text)) & low).astype(np.int32),
            ((key >> text) & low).astype(np.int32), (key & ((1 << text) - 1)).astype(np.uint16))


def chunk_blobs(texts: dict[bytes, list], numbering: Numbering, buckets: int, hash_of,
                chunk: int) -> Iterable[tuple[int, int, bytes]]:
    """(bucket, kind, blob) of the chunk numbered ``chunk``.  ``texts``: text -> [training copies].

    The number must be the chunk's own: chunks of equal texts would otherwise be
    summed as one.  The salt depends on the texts only."""
    keys = np.array([hash_of(t) for t in texts], np.uint64)
    copies = np.array([v[0] for v in texts.values()], np.int64)
    words, sizes = word_spans([t.lower() for t in texts])  # bytes.lower: A-Z only
    # codes: none, the start and the end, then the chunk's own words, ascending by number
    number = numbering.numbers(words.dictionary.to_pylist())
    order = np.argsort(number)
    code = np.empty(len(order), np.int32)
    code[order] = np.arange(3, len(order) + 3, dtype=np.int32)
    number = np.concatenate((np.array([NONE, START, END], np.uint64), number[order]))
    v = len(number)
    salt = int(np.bitwise_xor.reduce(mixed(keys, np.arange(len(keys), dtype=np.uint64)))) >> 1
    place_of = Places(number, salt % SALTS, buckets)
    doc = np.repeat(np.arange(len(sizes), dtype=np.uint16), sizes + 1)
    flat = np.full(len(doc), END, np.int32)
    ends = np.cumsum(sizes + 1) - 1
    body = np.ones(len(flat), bool)
    body[ends] = False
    flat[body] = code[words.indices.to_numpy(zero_copy_only=False)]
    del words, body, code, order
    yield home_of(chunk, buckets), 1, pack(np.array([chunk], np.int64), keys, (sizes + 1).astype(np.uint32))
    for pairs in (False, True):
        before = np.full(len(flat), NONE, np.int32)
        if pairs:
            before[1:] = flat[:-1]
            before[0] = START
            before[ends[:-1] + 1] = START
        place = place_of.pairs(before, flat) if pairs else place_of.words[flat]
        place, before, follow, d_ = in_order(place, before, flat, doc, buckets, v, len(sizes))
        new = np.ones(len(place), bool)
        new[1:] = (follow[1:] != follow[:-1]) | (before[1:] != before[:-1])
        ref = new.copy()
        ref[1:] |= d_[1:] != d_[:-1]
        at_ref = np.flatnonzero(ref)
        times = np.diff(np.append(at_ref, len(place))).astype(np.uint32)   # in this text
        at_new = np.flatnonzero(new)
        gram_of_ref = (np.cumsum(new, dtype=np.int32) - 1)[at_ref]
        d_ = d_[at_ref]
        held = np.bincount(gram_of_ref, minlength=len(at_new)).astype(np.uint32)  # texts with the n-gram
        trained = np.bincount(gram_of_ref, times * copies[d_], len(at_new)).astype(np.int64)
        step = d_.copy()  # texts of an n-gram ascend: what is kept is how far each lies from the one before
        again = gram_of_ref[1:] == gram_of_ref[:-1]
        step[1:][again] -= d_[:-1][again]
        first = np.concatenate(([0], np.cumsum(held, dtype=np.int64)))
        edge = np.searchsorted(place[at_new], np.arange(buckets + 1))
        a_, b_ = number[before[at_new]], number[follow[at_new]]
        del before, follow, place, new, ref, at_ref, gram_of_ref, d_
        for k in np.flatnonzero(np.diff(edge)).tolist():
            g = slice(edge[k], edge[k + 1])
            r = slice(first[edge[k]], first[edge[k + 1]])
            yield k, 0, framed(pack(*steps(a_[g], b_[g]), trained[g]), pack(np.array([chunk], np.int64), held[g], step[r], times[r]))


def texts_of(held: np.ndarray, step: np.ndarray) -> np.ndarray:
    """Text numbers of n-grams from their steps."""
    run = np.cumsum(step, dtype=np.int64)
    start = np.cumsum(held, dtype=np.int64) - held
    return (run - np.repeat(run[start] - step[start], held)).astype(np.uint16)


GRAMS = "<u8 <u8 <i8"
REFS = "<i8 <u4 <u2 <u4"
KEYS = "<i8 <u8 <u4"


def partition_keys(spark, n: int) -> list[int]:
    """For each of ``n`` hash partitions an int that Spark puts there: a bucket's rows get
    the key of its number, so every partition holds exactly one bucket."""
    found: dict[int, int] = {}
    start = 0
    while len(found) < n:
        ids = spark.range(start, start + 8 * n).select(F.col("id").cast("int").alias("k"))
        for k, p in ids.select("k", F.pmod(F.hash("k"), F.lit(n))).collect():
            found.setdefault(p, k)
        start += 8 * n
    return [found[p] for p in range(n)]


def _pack_task(numbering, keys: list[int]):
    buckets = len(keys)

    @releasing
    def run(batches):
        texts: dict[bytes, list] = {}
        size = 0
        number = TaskContext.get().partitionId() << 32  # a repeated task numbers its chunks alike

        def flush():
            nonlocal size, number
            out = chunk_blobs(texts, numbering.value, buckets, word_hash, number) if texts else iter(())
            while part := list(islice(out, 64)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([keys[x[0]] for x in part], pa.int32()), pa.array([x[1] for x in part], pa.int32()),
                     pa.array([x[2] for x in part], pa.binary())], names=["bucket", "kind", "blob"])
            texts.clear()
            size = 0
            number += 1

        for batch in batches:
            for text, train in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                raw = (text or "").encode("utf-8", "surrogatepass")
                own = texts.get(raw)
                if own is None:
                    own = texts[raw] = [0]
                    size += raw.count(b" ") + 2
                own[0] += bool(train)
                if size >= CHUNK_TOKENS or len(texts) >= 60_000:
                    yield from flush()
        yield from flush()

    return run


def added_up(grams: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, c) with every n-gram once, from lists of such arrays."""
    a, b, c = (np.concatenate(x) for x in zip(*grams))
    key = mixed(a, b)
    order = np.argsort(key)
    a, b, c, key = a[order], b[order], c[order], key[order]
    other = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    if (other & (key[1:] == key[:-1])).any():  # two n-grams of one hash
        order = np.lexsort((b, a))
        a, b, c = a[order], b[order], c[order]
        other = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    at = np.flatnonzero(np.concatenate((np.ones(min(1, len(a)), bool), other)))
    return a[at], b[at], np.add.reduceat(c, at) if len(at) else c


@releasing
def _count_bucket(part):
    """Training counts of the bucket's n-grams, added up as they come."""
    held, rows = [], 0
    for _, kind, blob in part:
        if kind == 0:
            da, db, c = unpack(unframed(bytes(blob))[0], GRAMS)
            a, b = stepped(da, db)
            keep = c > 0
            held.append((a[keep], b[keep], c[keep]))
            rows += len(held[-1][0])
            if rows >= MERGE_ROWS + len(held[0][0]):
                held = [added_up(held)]
                rows = len(held[0][0])
    if rows:
        a, b, c = added_up(held)
        del held
        order = np.lexsort((b, a))  # the written table is denser
        a, b, c = a[order], b[order], c[order]
        yield (pack(a, b, c, is_shared(a, b).astype(np.int8)),)


@releasing
def _unpack_counts(batches):
    for batch in batches:
        for blob in batch.column(0).to_pylist():
            a, b, c, shared = unpack(blob, "<u8 <u8 <i8 <i1")
            a, b, shared = a.view(np.int64), b.view(np.int64), shared.astype(bool)
            for i in range(0, len(a), 50_000):
                yield pa.RecordBatch.from_arrays([pa.array(x[i:i + 50_000]) for x in (a, b, c, shared)],
                                                 names=["a", "b", "c", "shared"])


def _pack_values(keys: list[int]):
    """Counted n-grams (a, b, c, cb) by bucket; shared ones go to the buckets of all salts."""
    buckets = len(keys)

    def packed(columns):
        a, b = (np.concatenate(x).astype(np.int64).view(np.uint64) for x in columns[:2])
        c, cb = (np.concatenate(x).astype(np.int64) for x in columns[2:])
        more = np.flatnonzero(is_shared(a, b))
        idx, place = [np.arange(len(a))], [places(a, b, 0, buckets)]
        for salt in range(1, SALTS):
            idx.append(more)
            place.append(places(a[more], b[more], salt, buckets))
        idx, place = np.concatenate(idx), np.concatenate(place)
        rank = np.empty(len(a), np.int64)  # ascending by first and second word
        rank[np.lexsort((b, a))] = np.arange(len(a))
        a[rank], b[rank], c[rank], cb[rank] = a.copy(), b.copy(), c.copy(), cb.copy()
        cb[b <= np.uint64(END + COMMON)] = 0  # the model has the counts of common words
        pair = np.unique(place.astype(np.int64) * len(a) + rank[idx])  # a bucket gets an n-gram once
        idx, place = pair % len(a), pair // len(a)
        edge = np.searchsorted(place, np.arange(buckets + 1))
        for k in np.flatnonzero(np.diff(edge)).tolist():
            i = idx[edge[k]:edge[k + 1]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([keys[k]], pa.int32()), pa.array([pack(*steps(a[i], b[i]), c[i], cb[i])], pa.binary())],
                names=["bucket", "blob"])

    @releasing
    def run(batches):
        held, rows = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append([batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)])
                rows += batch.num_rows
            if rows >= VALUE_ROWS:
                yield from packed(list(zip(*held)))
                held, rows = [], 0
        if held:
            yield from packed(list(zip(*held)))

    return run


class Model:
    """What every bucket needs: totals, discounts, and the sums of hot contexts."""

    def __init__(self, total=0, kinds=0, fix=1.0, unknown=1.0, words=None, pairs=None):
        self.total, self.kinds, self.fix, self.unknown = total, kinds, fix, unknown
        self.words, self.pairs = words or {}, pairs or {}
        self.hot: dict[int, tuple] = {}  # context -> (factor, log a, count)
        self.common = np.zeros(END + COMMON + 1, np.int64)  # counts of words with small numbers

    @staticmethod
    def _discounted(c: np.ndarray, d: dict[int, float]) -> np.ndarray:
        table = np.ones(KNOWN + 2)
        for r, x in d.items():
            table[r] = x
        return c * table[np.minimum(c, KNOWN + 1)]

    def p(self, c: np.ndarray) -> np.ndarray:
        """Probabilities of words from their counts."""
        return self._discounted(c, self.words) * (self.fix / max(self.total, 1))

    def context(self, dc, pb, cv):
        """(factor, log a) from a context's discounted counts, backed-off mass and count."""
        kept = dc / cv
        factor = np.where(1 - kept < 0.5 / (cv + 1), (1 - 1 / (cv + 1)) / kept, 1.0)
        return factor, np.log10((1 - factor * kept) / (1 - pb))

    def values(self, a, b, c, cb):
        """Value of each n-gram of a bucket: words log P + log a, pairs their correction."""
        word = a == NONE
        out = np.zeros(len(a))
        out[word] = np.log10(self.p(c[word]))
        own_w, own_c = b[word], c[word]
        order = np.argsort(own_w)
        own_w, own_c, slot = own_w[order], own_c[order], np.flatnonzero(word)[order]
        pa_, pc, pcb = a[~word], c[~word], cb[~word]
        dc, pb = self._discounted(pc, self.pairs), self.p(pcb)
        ctx, back = np.unique(pa_, return_inverse=True)
        factor, la, cv = np.ones(len(ctx)), np.zeros(len(ctx)), np.ones(len(ctx))
        hot = ctx <= np.uint64(END + HOT)
        if len(ctx):
            at = np.searchsorted(own_w, ctx[~hot])
            cv[~hot] = own_c[at]  # a context's own count is in its bucket
            sums, mass = np.bincount(back, dc, len(ctx)), np.bincount(back, pb, len(ctx))
            factor[~hot], la[~hot] = self.context(sums[~hot], mass[~hot], cv[~hot])
            for i in np.flatnonzero(hot).tolist():
                factor[i], la[i], cv[i] = self.hot[int(ctx[i])]
            out[~word] = np.log10(factor[back] * dc / cv[back]) - la[back] - np.log10(pb)
            found = np.searchsorted(own_w, ctx)
            has = found < len(own_w)
            has[has] = own_w[found[has]] == ctx[has]
            has &= ~hot
            out[slot[found[has]]] += la[has]
        warm = own_w <= np.uint64(END + HOT)
        for i in np.flatnonzero(warm).tolist():
            if int(own_w[i]) in self.hot:
                out[slot[i]] += self.hot[int(own_w[i])][1]
        return out


def _per_text(doc: np.ndarray, parts) -> tuple[np.ndarray, list[np.ndarray]]:
    docs = np.flatnonzero(np.bincount(doc)).astype(np.uint16)
    return docs, [np.bincount(doc, x)[docs] for x in parts]


def _sum_bucket(model, keys: list[int]):
    """Sums of the bucket's n-gram values per text: (key of the chunk's home, kind 3, chunk,
    blob of text numbers and sums); the chunks' own blobs (kind 1) go along."""
    @releasing
    def run(both):
        rows, values = both
        counted = [unpack(bytes(v[1]), "<u8 <u8 <i8 <i8") for v in values]
        counted = [(*stepped(da, db), c, cb) for da, db, c, cb in counted]
        blobs = [r[2] for r in rows if r[1] == 0]
        yield from ((r[0], 1, 0, bytes(r[2])) for r in rows if r[1] == 1)
        m = model.value
        unseen = float(np.log10(m.unknown))
        none = np.empty(0, np.uint64), np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
        va, vb, vc, vcb = (np.concatenate(x) for x in zip(*counted)) if counted else none
        del counted, both, rows, values
        small = np.flatnonzero((va != NONE) & (vb <= np.uint64(END + COMMON)))
        vcb[small] = m.common[vb[small]]
        vs = m.values(va, vb, vc, vcb)
        del vcb, small
        key = mixed(va, vb)
        order = np.argsort(key)
        va, vb, vs, vc, key = va[order], vb[order], vs[order], vc[order], key[order]
        # what a chunk's words and pairs add to its texts leaves the bucket as one blob
        sums: dict[int, list] = {}
        for blob in blobs:
            grams, refs = unframed(bytes(blob))
            (da, db, _), (chunk, held, step, times) = unpack(grams, GRAMS), unpack(refs, REFS)
            (a, b), doc = stepped(da, db), texts_of(held, step)
            value, count = np.zeros(len(a)), np.zeros(len(a), np.int64)
            word = a == NONE
            value[word] = unseen
            if len(key):
                at = np.minimum(np.searchsorted(key, mixed(a, b)), len(key) - 1)
                hit = (va[at] == a) & (vb[at] == b)
                value[hit] = vs[at[hit]]
                count[hit] = vc[at[hit]]
            count[~word] = 0
            base = np.zeros(len(a))  # a function of the words' counts; +0.5 as in the contract
            base[word] = np.log10(count[word] + 0.5)
            gram = np.repeat(np.arange(len(a)), held)
            parts = value[gram] * times, base[gram] * times, (count > 0)[gram] * times
            sums.setdefault(int(chunk[0]), []).append(_per_text(doc, parts))
        for chunk, found in sums.items():
            docs, parts = _per_text(np.concatenate([d for d, _ in found]),
                                    [np.concatenate(x) for x in zip(*[p for _, p in found])])
            yield keys[home_of(chunk, len(keys))], 3, chunk, pack(docs, parts[0], parts[1], parts[2].astype(np.uint32))

    return run


@releasing
def _rows_of_chunks(batches):
    """Per text of a chunk: (key, tokens, sum of values, base sum, known tokens)."""
    sums: dict[int, list] = {}
    own: dict[int, tuple] = {}
    for batch in batches:
        for kind, chunk, blob in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3))):
            if kind == 1:
                number, key, tokens = unpack(blob, KEYS)
                own[int(number[0])] = key, tokens
            else:
                sums.setdefault(chunk, []).append(blob)
    for chunk, (key, tokens) in own.items():
        out = np.zeros((3, len(key)))
        for blob in sums.get(chunk, ()):
            docs, s, base, known = unpack(blob, "<u2 <f8 <f8 <u4")
            out[0][docs] += s
            out[1][docs] += base
            out[2][docs] += known
        yield pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (key.view(np.int64), tokens.astype(np.int64), out[0], out[1], out[2].astype(np.int64))],
            names=["key", "n_tokens", "s", "base", "n_known"])


def common_words(docs: DataFrame, rows: int) -> list[int]:
    """Hashes of the most frequent words of about ``SAMPLE`` texts: they only get shorter numbers."""
    sample = docs.select("text").filter(F.pmod(F.xxhash64(F.lit(8), "text"), F.lit(max(1, rows // SAMPLE))) == 0)
    # lower() may differ from A-Z lowering beyond ASCII; such words merely stay uncommon
    words = sample.select(F.explode(F.split(F.lower("text"), "[\\x20\\x09-\\x0D]+")).alias("w"))
    top = words.filter("w <> ''").groupBy("w").count().orderBy(F.desc("count"), "w").limit(COMMON).select("w").collect()
    return list(dict.fromkeys(word_hash(r[0].encode("utf-8", "surrogatepass")) for r in top))


def discounts(n: dict[int, int], known: int = KNOWN) -> dict[int, float]:
    """Good-Turing discounts d_1 .. d_known from counts of counts (Katz's form);
    where the counts are too few for them to lie in (0, 1), absolute discounting."""
    n1, top = n.get(1, 0), n.get(known + 1, 0)
    a = (known + 1) * top / n1 if n1 else 1.0
    out = {}
    for r in range(1, known + 1):
        d = 0.0
        if n.get(r) and a < 1:
            d = ((r + 1) * n.get(r + 1, 0) / (r * n[r]) - a) / (1 - a)
        if not 0 < d < 1:
            two = n1 + 2 * n.get(2, 0)
            d = (r - (n1 / two if two and n1 < two else 0.5)) / r
        out[r] = d
    return out


def _counts_of_counts(t: DataFrame) -> dict[int, int]:
    return {int(r[0]): int(r[1]) for r in t.filter(F.col("c") <= KNOWN + 1).groupBy("c").count().collect()}


def fit(counts: DataFrame, train_texts: int) -> tuple[DataFrame | None, Model]:
    """(counted n-grams with the count of their second word, model) from (a, b, c, shared)."""
    counts = staged(counts, "ngrams", "zstd")  # once: both halves below read the table
    shared = staged(counts.filter("shared").groupBy("a", "b").agg(F.sum("c").alias("c")), "shared-ngrams")
    grams = counts.filter("not shared").drop("shared").unionByName(shared)
    uni = grams.filter(F.col("a") == NONE)
    pairs = grams.filter(F.col("a") != NONE)
    by_count = {int(r[0]): int(r[1]) for r in uni.groupBy(F.least("c", F.lit(KNOWN + 1)).alias("c"))
                .agg(F.sum("c")).collect()}
    total, kinds = uni.agg(F.sum("c"), F.count(F.lit(1))).first()
    if not total:
        return None, Model()
    du = discounts(_counts_of_counts(uni))
    mass = sum(v * du.get(r, 1.0) for r, v in by_count.items()) / total
    fix = 1.0 if mass < 1 - 1e-12 else total / (total + 1.0)
    model = Model(int(total), int(kinds), fix, 1 - mass * fix, du, discounts(_counts_of_counts(pairs)))
    second = uni.select("b", F.col("c").alias("cb"))
    # words with small numbers (at most COMMON) are the second ones of many pairs each
    kept = (pairs.filter("b > 0").join(F.broadcast(second.filter("b > 0")), "b").select("a", "b", "c", "cb")
                 .unionByName(pairs.filter("b < 0").join(second.filter("b < 0"), "b").select("a", "b", "c", "cb")))
    # contexts dealt over several buckets: at most HOT of them, summed by the few counts that occur
    hot = kept.filter(F.col("a").between(START, END + HOT))
    sums: dict[int, list] = {}

    def discounted(col, d):
        e = F.when(col > KNOWN, col.cast("double"))
        for r, x in d.items():
            e = e.when(col == r, F.lit(x * r))
        return e

    for a, dc, pb in hot.groupBy("a").agg(F.sum(discounted(F.col("c"), model.pairs)),
                                          F.sum(discounted(F.col("cb"), model.words))).collect():
        sums[a] = [dc, pb * fix / total]
    sizes = dict(uni.filter(F.col("b") <= END + HOT).filter(F.col("b") > 0).select("b", "c").collect())
    sizes[START] = train_texts
    small = uni.filter(F.col("b").between(END, END + COMMON)).select("b", "c").toArrow()  # at most COMMON + 1 rows
    model.common[small["b"].to_numpy()] = small["c"].to_numpy()
    for a, (dc, pb) in sums.items():
        factor, la = model.context(np.float64(dc), np.float64(pb), np.float64(sizes[a]))
        model.hot[a] = (float(factor), float(la), float(sizes[a]))
    return uni.select("a", "b", "c", F.lit(0).cast("long").alias("cb")).unionByName(kept), model


def katz_scores(docs: DataFrame, held_out: tuple[int, int] = HELD_OUT) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = prepare(docs.sparkSession)
    sc = spark.sparkContext
    mod, rest = held_out
    held = crc_mod(F.col("doc_id"), mod) == rest
    rows, size = docs.agg(F.count(F.lit(1)), F.sum(F.octet_length("text"))).first()
    buckets = max(shuffle_width(spark), (size or 0) // BUCKET_BYTES)
    keys = partition_keys(spark, buckets)
    numbering = sc.broadcast(Numbering(common_words(docs, rows)))
    packed = docs.select("text", (~held).alias("train")).mapInArrow(
        _pack_task(numbering, keys), "bucket int, kind int, blob binary")
    blobs = packed.repartition(buckets, "bucket").rdd  # both jobs below read this one shuffle
    counted = spark.createDataFrame(blobs.mapPartitions(_count_bucket), "blob binary")
    counts = counted.mapInArrow(_unpack_counts, "a long, b long, c long, shared boolean")
    grams, model = fit(counts, docs.filter(~held).count())
    values = grams if grams is not None else spark.createDataFrame([], "a long, b long, c long, cb long")
    back = values.mapInArrow(_pack_values(keys), "bucket int, blob binary").repartition(buckets, "bucket").rdd
    # equal keys and widths: a bucket's texts meet its values, and nothing moves again.  A partition
    # becomes one element; as a lambda of builtins this needs no library in the workers that run it
    whole = lambda part: [[tuple(r) for r in part]]
    dealt = blobs.mapPartitions(whole).zip(back.mapPartitions(whole))
    sums = spark.createDataFrame(dealt.flatMap(_sum_bucket(sc.broadcast(model), keys)),
                                 "bucket int, kind int, chunk long, blob binary", verifySchema=False)
    rows = sums.repartition(buckets, "bucket").mapInArrow(
        _rows_of_chunks, "key long, n_tokens long, s double, base double, n_known long")
    # a text may occur in several chunks, with the same sums
    per_text = rows.groupBy("key").agg(F.min("n_tokens").alias("n_tokens"), F.min("s").alias("s"),
                                       F.min("base").alias("base"), F.min("n_known").alias("n_known"))
    smooth = float(np.log10(model.total + 0.5 * (model.kinds + 1)))
    start = model.hot[START][1] if START in model.hot else 0.0
    ids = docs.select("doc_id", held.alias("held_out"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("key"))
    return (ids.join(per_text, "key", "left")
               .select("doc_id", "held_out", "n_tokens", "n_known", F.lit(model.total).cast("long").alias("train_tokens"),
                       (F.col("base") - F.col("n_tokens") * F.lit(smooth)).alias("base_score"),
                       (F.col("s") + F.lit(start)).alias("score")))


def op8_katz(spark, sf_dir):
    return katz_scores(documents(spark, sf_dir).select("doc_id", "text"))
