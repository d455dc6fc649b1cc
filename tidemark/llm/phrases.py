"""Operator 13 - phrase collocations by best-first branch-and-bound growth.

A phrase of 2 to 5 words scores, at its worst cut into a first part and a rest,
floor(1000 a n / (l r)) from exact counts.  A phrase occurs at most as often as
either part, so a <= r and its score is at most floor(1000 n / l) for every first
part.  Of these the first word, the most frequent one, gives the tightest bound,
and it holds for everything that grows from that word.  The frontier is therefore
expanded from the rarest first words (highest bounds) on.

Growth.  The words of every language are counted.  A first batch of first words,
those with the best bounds holding ``SHARE`` of the occurrences of counted
words, is grown word by word: a pass over the texts counts every one-word
extension of the phrases that reached ``min_count`` (of three-word phrases every
extension up to five words); a further pass counts the rests of the cuts that begin with words outside the
batch.  If a language then has ``top`` surviving phrases, the score of the last
of them, ties included, settles which first words can still matter: those whose
bound reaches it form the second and last batch; words below are never grown.
A language with fewer survivors grows all its words.

A phrase lies inside an equally frequent longer one exactly if all its
occurrences have the same neighbour on one side, so each count carries the
smallest and largest hash of the left and of the right neighbour.

What a pass is told (words and phrases to extend) travels as bit maps of at
most 2^``MAP_BITS`` hashed slots, whatever the corpus.  A slot shared by chance
makes a pass count a phrase more, never a wrong count: all occurrences of a
phrase meet the same slots; an exact join then keeps what was asked for.
Counts are combined per chunk of text in the task and added up by Spark, so a
hot phrase or language is one row per chunk.

Defined results: a null text has no words; a null language is ``und``; repeated
rows count as often as they occur; ties in score are ranked by count, then by
phrase in byte order; a language without candidates, or an empty table, gives
no rows; other columns are not read.  A text larger than a chunk is a chunk of
its own.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import documents, prepare, staged

MIN_COUNT = 100
MAX_WORDS = 5
TOP = 2000
#: Occurrences of counted words that the first batch of first words holds.
SHARE = 1 / 8
#: Bytes of text counted at a time.
CHUNK = 8 << 20
MAP_BITS = 27
_BREAK = 0xFF  # occurs in no UTF-8 text
_TO_BREAK = bytes.maketrans(b".,;:!?\n\x0b\x0c\r", bytes([_BREAK]) * 10)
COUNTED = "lang string, k int, phrase binary, c long, llo long, lhi long, rlo long, rhi long"


def chained(h: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Hash of a phrase from the hash of its first words and that of its last word."""
    with np.errstate(over="ignore"):
        x = (h ^ np.uint64(0x2545F4914F6CDD1D)) * np.uint64(0x9E3779B97F4A7C15) + w
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(29))


def lang_hash(lang: str) -> np.uint64:
    return np.uint64(xxhash.xxh64_intdigest(lang.encode("utf-8", "surrogatepass"), 7))


def word_hashes(words) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(w, 42) for w in words], np.uint64)


def phrase_hash(lang: str, phrase: bytes) -> np.uint64:
    return reduce(chained, word_hashes(phrase.split(b" ")), lang_hash(lang))


class Words:
    """The words of some texts of one language: codes into a dictionary, piece numbers."""

    def __init__(self, texts: list[bytes]):
        raw = bytes([_BREAK]).join(texts).lower().translate(_TO_BREAK)  # bytes.lower: A-Z only
        a = np.frombuffer(raw, np.uint8)
        cut = (a == 32) | (a == 9) | (a == _BREAK)
        edge = np.flatnonzero(np.diff(np.concatenate(([True], cut, [True])).astype(np.int8)))
        starts, ends = edge[0::2], edge[1::2]
        self.piece = np.searchsorted(np.flatnonzero(a == _BREAK), starts).astype(np.int32)
        offsets = np.empty(2 * len(starts) + 1, np.int32)
        offsets[0:-1:2], offsets[1::2], offsets[-1] = starts, ends, len(raw)
        spans = pa.Array.from_buffers(pa.binary(), 2 * len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(raw)])
        d = spans.take(pa.array(np.arange(0, 2 * len(starts), 2))).dictionary_encode()
        self.codes = d.indices.to_numpy(zero_copy_only=False)
        self.words = d.dictionary

    def __len__(self):
        return len(self.codes)


def _table(lang, k, phrases, counts, marks):
    """A batch of the columns of ``COUNTED``."""
    n = len(phrases)
    return pa.RecordBatch.from_arrays(
        [pa.array([lang] * n, pa.string()), pa.array(np.full(n, k, np.int32)), phrases, pa.array(counts.astype(np.int64)),
         *[pa.array(m.view(np.int64)) for m in marks]],
        names=["lang", "k", "phrase", "c", "llo", "lhi", "rlo", "rhi"])


def count_words(lang: str, w: Words):
    """Every word with its count, and the number of words as the count of the empty phrase."""
    zero = np.zeros(len(w.words), np.uint64)
    yield _table(lang, 1, w.words.cast(pa.binary()), np.bincount(w.codes, minlength=len(w.words)), [zero] * 4)
    yield _table(lang, 0, pa.array([b""], pa.binary()), np.array([len(w)]), [zero[:1]] * 4)


def count_phrases(lang: str, w: Words, asked):
    """Counts of the phrases asked for, with the extremes of their neighbours' hashes (0: none)."""
    (stem, stems, reach), frequent, wanted = asked
    own = word_hashes(w.words.to_pylist())
    at = own[w.codes]
    ok = frequent.holds(chained(lang_hash(lang), own))[w.codes]
    h = chained(lang_hash(lang), at)
    grows = np.zeros(len(w), bool)
    for k in range(2, max([reach, *wanted]) + 1):
        if len(w) < k:
            return
        before, h = h, chained(h[:-1], at[k - 1:])
        if k == stem + 1:
            grows = ok[:len(h)] & stems.holds(before[:-1])
        grows = grows[:len(h)] & ok[k - 1:]
        take = grows & (stem < k <= reach)
        if k in wanted:
            take |= wanted[k].holds(h)
        take &= w.piece[:len(h)] == w.piece[k - 1:]
        pos = np.flatnonzero(take)
        if len(pos):
            yield _grouped(lang, k, w, at, pos, h[pos])


def _grouped(lang, k, w, at, pos, h):
    order = np.argsort(h, kind="stable")
    pos, h = pos[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = h[1:] != h[:-1]
    first = np.flatnonzero(new)
    rep = pos[first][np.cumsum(new) - 1]
    if any((w.codes[pos + j] != w.codes[rep + j]).any() for j in range(k)):  # two phrases of one hash
        order = np.lexsort([w.codes[pos + j] for j in range(k)])
        pos = pos[order]
        new[1:] = reduce(np.logical_or, [w.codes[pos[1:] + j] != w.codes[pos[:-1] + j] for j in range(k)])
        first = np.flatnonzero(new)
    left, right = np.zeros(len(pos), np.uint64), np.zeros(len(pos), np.uint64)
    has = pos > 0
    has[has] = w.piece[pos[has] - 1] == w.piece[pos[has]]
    left[has] = at[pos[has] - 1]
    has = pos + k < len(w)
    has[has] = w.piece[pos[has] + k] == w.piece[pos[has]]
    right[has] = at[pos[has] + k]
    heads = pos[first]
    parts = [w.words.take(pa.array(w.codes[heads + j])) for j in range(k)]
    phrases = pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.binary()))
    # signed extremes, as Spark compares longs
    marks = [f.reduceat(x.view(np.int64), first).view(np.uint64) for x in (left, right) for f in (np.minimum, np.maximum)]
    return _table(lang, k, phrases, np.diff(np.append(first, len(pos))), marks)


class Slots:
    """A set of hashes as a bit map of 2^bits slots."""

    def __init__(self, bits: int, chunks: dict[int, bytes]):
        self.bits = bits
        self.map = np.zeros(max(1, (1 << bits) // 8), np.uint8)
        for number, chunk in chunks.items():
            room = self.map[number * 4096:(number + 1) * 4096]
            room[:] = np.frombuffer(chunk, np.uint8)[:len(room)]

    def holds(self, h: np.ndarray) -> np.ndarray:
        slot = h & np.uint64((1 << self.bits) - 1)
        return (self.map[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def slots_of(phrases: DataFrame) -> Slots:
    """Bit map of the phrases (lang, phrase) of a table; at most 2^MAP_BITS bits reach the driver."""
    bits = min(MAP_BITS, max(15, math.ceil(math.log2(64 * phrases.count() + 1))))
    mask = np.uint64((1 << bits) - 1)

    def hashed(batches):
        for b in batches:
            hs = [phrase_hash(x, y) & mask for x, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(np.array(hs, np.uint64).view(np.int64))], names=["slot"])

    s = phrases.select("lang", "phrase").mapInArrow(hashed, "slot long").distinct()
    chunks = (s.groupBy(F.floor(F.col("slot") / 32768).alias("b"))
               .agg(F.bitmap_construct_agg(F.col("slot") % 32768).alias("m")))
    return Slots(bits, {r.b: bytes(r.m) for r in chunks.collect()})


def counted(docs: DataFrame, count, asked=None) -> DataFrame:
    """(lang, k, phrase, a, left_one, right_one): what ``count`` finds in the texts, added up.

    ``left_one`` says that all occurrences have one same word before them."""
    asked = docs.sparkSession.sparkContext.broadcast(asked)

    def run(batches):
        held: dict[str, list[bytes]] = {}
        sizes: dict[str, int] = {}

        def flush(lang):
            w = Words(held.pop(lang))
            sizes.pop(lang)
            if len(w):
                yield from count(lang, w) if asked.value is None else count(lang, w, asked.value)

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held.setdefault(lang, []).append(text)
                sizes[lang] = sizes.get(lang, 0) + len(text) + 1
                if sum(sizes.values()) >= CHUNK:
                    yield from flush(max(sizes, key=sizes.get))
        for lang in list(held):
            yield from flush(lang)

    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.col("text").cast("binary").alias("text"))
    rows = texts.filter("text is not null").mapInArrow(run, COUNTED)
    sums = rows.groupBy("lang", "k", "phrase").agg(
        F.sum("c").alias("a"), F.min("llo").alias("llo"), F.max("lhi").alias("lhi"),
        F.min("rlo").alias("rlo"), F.max("rhi").alias("rhi"))
    return sums.select("lang", "k", "phrase", "a", F.expr("llo = lhi AND llo <> 0").alias("left_one"),
                       F.expr("rlo = rhi AND rlo <> 0").alias("right_one"))


def _part(first: int, words) -> F.Column:
    """``words`` words of the phrase from word ``first`` (1-based) on."""
    split = F.split(F.col("phrase").cast("string"), " ")
    return F.array_join(F.slice(split, first, words), " ").cast("binary")


def grown(docs: DataFrame, words: DataFrame, batch: DataFrame, known: DataFrame | None, frequent: Slots,
          min_count: int, max_words: int) -> tuple[DataFrame, DataFrame]:
    """(candidates that begin with a word of ``batch``, counts of the rests of their cuts)."""
    spark = docs.sparkSession
    none = spark.createDataFrame([], "lang string, k int, phrase binary, a long, left_one boolean, right_one boolean")
    level, found = batch, none
    # from three words on few phrases are left: the last step grows by all the words that remain
    for stem, reach in [(k, k + 1) for k in range(1, min(3, max_words))] + [(3, max_words)] * (max_words > 3):
        asked = (stem, slots_of(level), reach), frequent, {}
        prefix = level.select("lang", F.col("phrase").alias("_p"))
        ext = counted(docs, count_phrases, asked).filter(F.col("a") >= min_count)
        level = staged(ext.withColumn("_p", _part(1, stem)).join(prefix, ["lang", "_p"], "left_semi").drop("_p"),
                       f"phrases{reach}")
        found = found.unionByName(level)
        if level.isEmpty():
            break
    rests = (found.filter("k > 2").select("lang", "phrase", "k", F.explode(F.sequence(F.lit(2), F.col("k") - 1)).alias("i"))
                  .select("lang", (F.col("k") - F.col("i") + 1).alias("k"),
                          _part_from(F.col("i")).alias("phrase")).distinct())
    have = found if known is None else found.unionByName(known)
    rests = staged(rests.join(have.select("lang", "phrase"), ["lang", "phrase"], "left_anti"), "rests")
    sizes = [r.k for r in rests.select("k").distinct().collect()]
    if not sizes:
        return found, none
    asked = (0, None, 0), frequent, {k: slots_of(rests.filter(F.col("k") == k)) for k in sizes}
    counts = counted(docs, count_phrases, asked).join(rests.select("lang", "phrase"), ["lang", "phrase"], "left_semi")
    return found, staged(counts.select(none.columns), "rest-counts")


def _part_from(i) -> F.Column:
    split = F.split(F.col("phrase").cast("string"), " ")
    return F.array_join(F.slice(split, i, F.size(split)), " ").cast("binary")


def scored(found: DataFrame, counts: DataFrame, totals: DataFrame, max_words: int) -> DataFrame:
    """The surviving candidates with the parts' counts and score of their worst cut."""
    live = found.filter((F.col("k") == max_words) | ~(F.col("left_one") | F.col("right_one")))
    cuts = live.select("lang", "phrase", "a", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cuts = cuts.withColumn("_l", _part(1, F.col("cut"))).withColumn("_r", _part_from(F.col("cut") + 1))
    c = counts.select("lang", "phrase", "a")
    cuts = (cuts.join(c.select("lang", F.col("phrase").alias("_l"), F.col("a").alias("l")), ["lang", "_l"])
                .join(c.select("lang", F.col("phrase").alias("_r"), F.col("a").alias("r")), ["lang", "_r"])
                .join(totals, "lang"))
    # exact: products of counts may pass 64 bits
    score = F.expr("(CAST(1000 * a AS DECIMAL(19,0)) * CAST(n AS DECIMAL(19,0)))"
                   " div (CAST(l AS DECIMAL(19,0)) * CAST(r AS DECIMAL(19,0)))")
    worst = cuts.withColumn("score", score).groupBy("lang", "phrase", "a", "n").agg(
        F.min(F.struct("score", "cut", "l", "r")).alias("w"))
    return worst.select("lang", F.col("phrase").cast("string").alias("phrase"), "a", "w.l", "w.r", "n", "w.score")


def ranked(scores: DataFrame, top: int) -> DataFrame:
    w = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return scores.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top)


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, top: int = TOP,
                 share: float = SHARE) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first ``top`` surviving phrases of each language."""
    prepare(docs.sparkSession)
    ones = staged(counted(docs, count_words).filter((F.col("a") >= min_count) | (F.col("k") == 0)), "words")
    totals = ones.filter("k = 0").select("lang", F.col("a").alias("n"))
    words = ones.filter("k = 1")
    frequent = slots_of(words)
    # first words with the best bounds, in classes of 1/16 octave of their count
    band = F.floor(F.log2(F.col("a").cast("double")) * 16).cast("int")
    bands = words.groupBy("lang", band.alias("band")).agg(F.sum("a").alias("mass"))  # at most 1,024 rows a language
    w = Window.partitionBy("lang").orderBy("band")
    part = F.sum("mass").over(w.rowsBetween(Window.unboundedPreceding, -1)) / F.sum("mass").over(Window.partitionBy("lang"))
    firsts = bands.select("lang", "band", part.alias("part")).filter((F.coalesce("part", F.lit(0.0)) < share))
    limit = firsts.groupBy("lang").agg(F.max("band").alias("limit"))
    words = staged(words.withColumn("band", band).join(limit, "lang")
                        .withColumn("early", F.col("band") <= F.col("limit")).drop("band", "limit"), "first-words")
    found, rests = grown(docs, words, words.filter("early"), None, frequent, min_count, max_words)
    counts = words.select(found.columns).unionByName(found).unionByName(rests)
    scores = staged(scored(found, counts, totals, max_words), "scores")
    # the score that a phrase must reach: that of the last place, where all places are taken
    need = (ranked(scores, top).filter(F.col("rank") == top).select("lang", F.col("score").alias("need")))
    late = staged(words.filter("not early").join(totals, "lang").join(need, "lang", "left")
                       .filter(F.expr("need IS NULL OR (1000 * CAST(n AS DECIMAL(19,0))) div a >= need"))
                       .select(found.columns), "late-words")
    if not late.isEmpty():
        more, more_rests = grown(docs, words, late, found.unionByName(rests), frequent, min_count, max_words)
        # a rest counted before may begin with a word of this batch; found again, it repeats a cut
        counts = counts.unionByName(more).unionByName(more_rests)
        scores = scores.unionByName(scored(more, counts, totals, max_words))
    return ranked(scores, top).select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n",
                                      "score")


def op13_phrases(spark, sf_dir):
    return collocations(documents(spark, sf_dir).select("lang", "text"))
