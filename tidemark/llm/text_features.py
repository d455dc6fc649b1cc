"""Dense per-document features of whole texts, shared by the two classifiers."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, staged

# Second-person words of the four languages of the corpus.
SECOND_PERSON = """you your yours yourself u ur thou
du dich dir dein deine deinen ihr euch euer eure sie
tu te toi ton ta tes vous votre vos
tú ti tus usted ustedes vosotros vuestra vuestro os""".split()
#: Characters that stand for letters in obfuscated words.
LEET = str.maketrans("013457@$!|", "oleastasil")
NEAR = 5
#: Lengths of the word beginnings that count as stems.
STEMS = (3, 4, 5, 6, 7, 8)
MAX_MEMO = 400_000
EDGE = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_SYMBOLS = frozenset(b"#*$%&|<>@^~=+_\\{}[]")

SECOND, HIT, HIDDEN, CAPS, SHOUT, SYMBOL, DIGIT, BARE = (1 << i for i in range(8))
NAMES = ["log_words", "hits", "log_hits", "hit_weight", "log_weight", "second", "near", "caps", "shout", "symbol", "digit",
         "bare", "hidden", "word_chars", "distinct", "dup_lines", "lines", "stops", "long_words", "repeats"]
SHOUT_CHARS = (b"!", b"?")


def squeeze(w: str) -> str:
    """A word with substituted letters restored, marks inside dropped, runs of a letter cut to one."""
    out = []
    for c in w.translate(LEET):
        if c.isalpha() and (not out or out[-1] != c):
            out.append(c)
    return "".join(out)


class Features:
    """Feature rows of texts.  ``lexicon`` maps lower-case words, and stems written
    ``stem*`` of ``STEMS`` characters, to weights above 0."""

    def __init__(self, lexicon: dict[str, float] | None = None):
        lexicon = lexicon or {}
        self.lexicon = {k.encode(): v for k, v in lexicon.items() if not k.endswith("*")}
        self.stems = {k[:-1]: v for k, v in lexicon.items() if k.endswith("*")}
        self.squeezed = {squeeze(k): v for k, v in lexicon.items() if len(k) >= 4 and not k.endswith("*")}
        self.second = {w.encode() for w in SECOND_PERSON}
        self.memo: dict[bytes, tuple] = {}

    def token(self, raw: bytes) -> int:
        """Flags | characters << 8 | lexicon weight (thousandths) << 16 of one word."""
        bare = raw.strip(EDGE)
        text = bare.decode("utf-8", "replace")
        low = text.lower()
        key = low.encode("utf-8", "replace")
        code = min(len(text), 255) << 8
        weight = self.lexicon.get(key, 0.0)
        if self.stems:
            weight = max(weight, 0.0, *(self.stems.get(low[:n], 0.0) for n in STEMS if len(low) > n))
        if weight:
            code |= HIT
        elif self.squeezed and not low.isalpha() or len(low) >= 5 and any(a == b == c for a, b, c in zip(low, low[1:], low[2:])):
            weight = self.squeezed.get(squeeze(raw.decode("utf-8", "replace").lower()), 0.0)
            if weight:
                code |= HIT | HIDDEN
        if key in self.second:
            code |= SECOND
        if len(text) > 1 and text.isupper():
            code |= CAPS
        if raw.endswith(SHOUT_CHARS):
            code |= SHOUT
        if not _SYMBOLS.isdisjoint(raw):
            code |= SYMBOL
        if any(48 <= b <= 57 for b in raw):
            code |= DIGIT
        if not bare:
            code |= BARE
        return code | int(weight * 1000) << 16

    def row(self, text: str | None) -> list[float]:
        raw = (text or "").encode("utf-8", "surrogatepass")
        words = raw.split()
        n = len(words)
        if not n:
            return [0.0] * len(NAMES)
        memo = self.memo
        codes = list(map(memo.get, words))
        if None in codes:
            if len(memo) > MAX_MEMO:
                memo.clear()
            for i, c in enumerate(codes):
                if c is None:
                    w = words[i]
                    c = memo.get(w)
                    if c is None:
                        c = self.token(w)
                        if len(w) < 64:
                            memo[w] = c
                    codes[i] = c
        c = np.array(codes, np.int64)
        hit = np.flatnonzero(c & HIT)
        near = 0
        if len(hit):
            you = np.flatnonzero(c & SECOND)
            if len(you):
                after = np.searchsorted(you, hit)
                gap = np.minimum(np.abs(you[np.minimum(after, len(you) - 1)] - hit),
                                 np.abs(hit - you[np.maximum(after - 1, 0)]))
                near = int((gap <= NEAR).sum())
        size = (c >> 8) & 255
        lines = raw.split(b"\n")
        kept = [x for x in lines if x.strip()]
        rate = lambda flag: np.count_nonzero(c & flag) / n
        kinds = len(set(words))
        weight = float((c >> 16).sum()) / 1000
        return [np.log1p(n), len(hit) / n, np.log1p(len(hit)), weight / n, np.log1p(weight), rate(SECOND),
                near / n, rate(CAPS), rate(SHOUT), rate(SYMBOL), rate(DIGIT), rate(BARE), rate(HIDDEN),
                float(size.mean()), kinds / n, 1 - len(set(kept)) / max(1, len(kept)), len(kept) / n,
                np.count_nonzero(size <= 3) / n, np.count_nonzero(size >= 15) / n,
                1 - kinds / n if n >= 50 else 0.0]

    def matrix(self, texts) -> np.ndarray:
        return np.array([self.row(t) for t in texts], np.float64).reshape(-1, len(NAMES))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, held_out: tuple[int, int],
                    limit: int) -> DataFrame:
    """(doc_id, label, text, key), staged: one row per different text of at most
    ``limit`` labelled ids that are not held out (the lowest keyed hashes).

    A text under several labels has that of most of its rows, 1 if they are even;
    ``doc_id`` is its smallest id and ``key`` a hash to sort by, so that a fit does
    not depend on how rows are dealt.  An id with many texts may bring more than
    ``limit`` of them; then about ``limit`` are taken by hash.
    """
    mod, rest = held_out
    ids = (labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull()
                         & (crc_mod(F.col("doc_id"), mod) != rest))
                 .groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
                 .orderBy(F.xxhash64(F.lit(11), "doc_id"), "doc_id").limit(limit))
    rows = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")  # at most ``limit`` ids
    texts = (rows.filter(F.col("text").isNotNull()).groupBy("text")
                 .agg(F.min("doc_id").alias("doc_id"), (F.avg("label") >= 0.5).cast("int").alias("label"))
                 .select("doc_id", "label", "text", F.xxhash64(F.lit(13), "text").alias("key")))
    sample = staged(texts, "sample")
    n = sample.count()
    return sample if n <= limit else sample.filter(F.pmod("key", F.lit(n)) < limit)


def sample_numbers(sample: DataFrame, *columns) -> list:
    """The named columns of a sample's rows, in the order of their keys."""
    rows = sample.select("key", "doc_id", *columns).collect()  # numbers of at most about ``limit`` rows
    return sorted(rows, key=lambda r: (r["key"], r["doc_id"]))
