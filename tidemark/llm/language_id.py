"""Operator 3 - language identification by a bidirectional gated recurrent net over bytes.

The net reads a segment of bytes forwards and backwards (two gated recurrent
units of ``HIDDEN`` states, reset applied after the recurrent product), gives
every position a distribution over the languages, and a document's
probabilities are the mean over all its positions.  It is trained in numpy by
backpropagation through time with Adam, every position labelled with the
language of its document.

Texts are read whole: each is cut into segments of ``SEGMENT`` bytes that are
run side by side, the state starting anew in each.  Gates are piecewise linear
(clipped) and the candidate is x / (1 + |x|): cheap per byte.

Training sees at most ``PER_LANG`` documents of a language and
``MAX_SEGMENTS`` segments shared equally among the languages found, but no
fewer than ``PIECES`` for each (the lowest keyed hashes of the id), from
documents that are not held out and have a language.  Scoring uses the text
alone.

Defined results: ``und`` with score 0 for a null text or one without a letter;
ties between languages go to the lower code; without any labelled document
every text is ``und``; repeated rows get equal results; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import crc_mod, documents, prepare, staged

HIDDEN = 8
SEGMENT = 128
LANES = 4096
PER_LANG = 500
PIECES = 3
MAX_SEGMENTS = 6000
TRAIN_BYTES = 48
STEPS = 260
BATCH = 192
HELD_OUT = (3, 1)  # modulus and remainder


class Direction:
    """One gated recurrent unit over byte columns (time x lanes)."""

    def __init__(self, rng, hidden: int):
        h = self.h = hidden
        self.p = {
            "W": rng.normal(0, 0.4, (256, 3 * h)).astype(np.float32),   # input of gates z, r and candidate n
            "U": (rng.normal(0, 1, (3 * h, h)) / np.sqrt(h)).astype(np.float32),
            "b": np.concatenate((np.full(h, 0.8), np.zeros(h), np.zeros(h))).astype(np.float32)[:, None],
        }

    def step(self, x, s):
        """x (3h x lanes) input terms, s (h x lanes) -> (z, r, u, n, next)."""
        h = self.h
        a = self.p["U"] @ s
        g = np.clip((x[:2 * h] + a[:2 * h]) * 0.25 + 0.5, 0, 1)
        z, r, u = g[:h], g[h:], a[2 * h:]
        c = x[2 * h:] + r * u
        n = c / (1 + np.abs(c))
        return z, r, u, n, n + z * (s - n)

    def forward(self, codes):
        """All states (time x h x lanes) and what ``backward`` needs."""
        t, lanes = codes.shape
        s, states, tape = np.zeros((self.h, lanes), np.float32), [], []
        for i in range(t):
            x = self.p["W"][codes[i]].T + self.p["b"]
            z, r, u, n, nxt = self.step(x, s)
            tape.append((s, z, r, u, n))
            states.append(nxt)
            s = nxt
        return np.stack(states), tape

    def backward(self, codes, tape, d_states):
        """Gradients given those of all states (backpropagation through time)."""
        h = self.h
        g = {k: np.zeros_like(v) for k, v in self.p.items()}
        d = np.zeros_like(tape[0][0])
        for i in range(len(tape) - 1, -1, -1):
            s, z, r, u, n = tape[i]
            d = d + d_states[i]
            d_n, d_z = d * (1 - z), d * (s - n)
            d_c = d_n * (1 - np.abs(n)) ** 2
            open_z, open_r = (z > 0) & (z < 1), (r > 0) & (r < 1)
            d_a = np.concatenate((d_z * open_z * 0.25, d_c * u * open_r * 0.25, d_c * r))
            d_x = np.concatenate((d_a[:2 * h], d_c))
            g["U"] += d_a @ s.T
            g["b"] += d_x.sum(axis=1, keepdims=True)
            np.add.at(g["W"], codes[i], d_x.T)
            d = d * z + self.p["U"].T @ d_a
        return g


class BiGru:
    def __init__(self, langs: list[str], hidden: int = HIDDEN, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.langs = langs
        self.fwd, self.bwd = Direction(rng, hidden), Direction(rng, hidden)
        k = len(langs)
        self.out = {"V": rng.normal(0, 0.3, (k, 2 * hidden)).astype(np.float32), "c": np.zeros((k, 1), np.float32)}

    def positions(self, sf, sb):
        """Distributions (time x languages x lanes) from both directions' states."""
        s = np.concatenate((sf, sb), axis=1)
        a = self.out["V"] @ s + self.out["c"]
        a -= a.max(axis=1, keepdims=True)
        e = np.exp(a)
        return s, e / e.sum(axis=1, keepdims=True)

    def gradients(self, codes, labels):
        """Mean cross-entropy over all positions, and the gradients of all parameters."""
        sf, tf = self.fwd.forward(codes)
        sb, tb = self.bwd.forward(codes[::-1])
        s, p = self.positions(sf, sb[::-1])
        t, _, lanes = p.shape
        loss = -np.log(p[:, labels, np.arange(lanes)] + 1e-9).mean()
        d = p.copy()
        d[:, labels, np.arange(lanes)] -= 1
        d /= t * lanes
        g_out = {"V": np.einsum("tkl,thl->kh", d, s), "c": d.sum(axis=(0, 2))[:, None]}
        ds = np.einsum("kh,tkl->thl", self.out["V"], d)
        h = self.fwd.h
        gf = self.fwd.backward(codes, tf, ds[:, :h])
        gb = self.bwd.backward(codes[::-1], tb, ds[::-1, h:])
        return loss, [(self.out, g_out), (self.fwd.p, gf), (self.bwd.p, gb)]

    def fit(self, codes: np.ndarray, labels: np.ndarray, steps: int = STEPS, batch: int = BATCH,
            rate: float = 0.02, seed: int = 4):
        """codes (segments x time), labels (segments)."""
        rng = np.random.default_rng(seed)
        mom: dict = {}
        weight = 1 / np.maximum(np.bincount(labels, minlength=len(self.langs)), 1)
        prob = weight[labels] / weight[labels].sum()  # languages alike
        for i in range(1, steps + 1):
            pick = rng.choice(len(codes), min(batch, len(codes)), p=prob)
            _, grads = self.gradients(np.ascontiguousarray(codes[pick].T), labels[pick])
            lr = rate * (1 - 0.9 * i / steps)
            for n, (params, g) in enumerate(grads):
                for k, v in g.items():
                    m = mom.setdefault((n, k), [np.zeros_like(v), np.zeros_like(v)])
                    m[0] += 0.1 * (v - m[0])
                    m[1] += 0.01 * (v * v - m[1])
                    up = (m[0] / (1 - 0.9 ** i)) / (np.sqrt(m[1] / (1 - 0.99 ** i)) + 1e-8)
                    params[k] -= (lr * up).astype(np.float32)
        return self

    def segment_sums(self, data: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
        """(segments x languages) sums of the position distributions.

        Segments are ordered by size, so at step t the running ones are the
        first lanes and nothing is padded.
        """
        order = np.argsort(-size, kind="stable")
        at, length = begin[order], size[order]
        lanes, top = len(order), int(length[0]) if len(order) else 0
        alive = np.searchsorted(-length, -np.arange(top), side="left")  # lanes longer than t
        h, f, b = self.fwd.h, self.fwd, self.bwd
        wf, wb = f.p["W"] + f.p["b"].T, b.p["W"] + b.p["b"].T
        kept = np.empty((top, h, lanes), np.float32)
        s = np.zeros((h, lanes), np.float32)
        for t in range(top):
            k = alive[t]
            s[:, :k] = f.step(wf[data[at[:k] + t]].T, s[:, :k])[4]
            kept[t, :, :k] = s[:, :k]
        v, c = self.out["V"], self.out["c"]
        vf, vb = np.ascontiguousarray(v[:, :h]), np.ascontiguousarray(v[:, h:])
        total = np.zeros((len(self.langs), lanes), np.float32)
        s = np.zeros((h, lanes), np.float32)
        for t in range(top - 1, -1, -1):
            k = alive[t]
            s[:, :k] = b.step(wb[data[at[:k] + t]].T, s[:, :k])[4]
            a = vf @ kept[t, :, :k] + vb @ s[:, :k] + c
            e = np.exp(np.minimum(a, 60))
            total[:, :k] += e / e.sum(axis=0)
        out = np.empty((lanes, len(self.langs)))
        out[order] = total.T
        return out

    def documents(self, texts) -> np.ndarray:
        """(documents x languages) pooled probabilities."""
        raws = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
        sizes = np.array([len(r) for r in raws], np.int64)
        sums = np.zeros((len(raws), len(self.langs)))
        group: list[int] = []
        segments = 0

        def run():
            if not group:
                return
            data = np.frombuffer(b"".join(raws[i] for i in group), np.uint8)
            n = -(-sizes[group] // SEGMENT)
            owner = np.repeat(np.arange(len(group)), n)
            nth = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
            start = (np.cumsum(sizes[group]) - sizes[group])[owner] + nth * SEGMENT
            size = np.minimum(SEGMENT, sizes[group][owner] - nth * SEGMENT)
            for lo in range(0, len(owner), LANES):
                part = slice(lo, lo + LANES)
                np.add.at(sums, np.array(group)[owner[part]], self.segment_sums(data, start[part], size[part]))

        for i, size in enumerate(sizes):
            if not size:
                continue
            group.append(i)
            segments += -(-int(size) // SEGMENT)
            if segments >= LANES:
                run()
                group, segments = [], 0
        run()
        return sums / np.maximum(sizes, 1)[:, None]


def training_segments(docs: DataFrame) -> DataFrame:
    """(lang, piece): a bounded sample of byte pieces of labelled, not held-out documents.

    The rows of every language are counted first; a hash threshold then leaves about
    twice ``PER_LANG`` of them, whose pieces are cut where they are: what is ranked
    and shuffled does not grow with the table.
    """
    mod, rest = HELD_OUT
    pool = docs.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & (crc_mod(F.col("doc_id"), mod) != rest))
    pool = pool.withColumn("_h", F.xxhash64(F.lit(3), "doc_id", "text"))
    many = pool.groupBy("lang").count().select("lang", F.greatest(F.lit(1), F.floor(F.col("count") / (2 * PER_LANG))).alias("_every"))
    many = staged(many, "languages")  # a row per language
    near = pool.join(many, "lang").filter(F.pmod(F.xxhash64("_h", F.lit(17)), F.col("_every")) == 0)
    pieces = near.select("lang", "_h", F.array(*[
        F.expr(f"substring(text, cast(1 + pmod(xxhash64(_h, {i}), greatest(length(text) - {TRAIN_BYTES}, 1)) as int), {TRAIN_BYTES})")
        for i in range(PIECES)]).alias("_pieces"))
    w = Window.partitionBy("lang").orderBy("_h")
    chosen = pieces.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= PER_LANG)
    chosen = chosen.select("lang", "_h", F.posexplode("_pieces").alias("_i", "piece"))
    w = Window.partitionBy("lang").orderBy("_h", "_i")
    pieces = staged(chosen.filter(F.col("piece").rlike(r"\p{L}")).withColumn("_n", F.row_number().over(w)), "pieces")
    langs = pieces.filter("_n = 1").count()
    each = max(MAX_SEGMENTS // max(langs, 1), PIECES)
    return pieces.filter(F.col("_n") <= each).orderBy("_h", "_i").select("lang", "piece")


def train(docs: DataFrame) -> BiGru | None:
    rows = training_segments(docs).collect()  # at most MAX_SEGMENTS pieces, or PIECES for each language
    langs = sorted({r[0] for r in rows})
    if not langs:
        return None
    codes = np.zeros((len(rows), TRAIN_BYTES), np.uint8)
    for i, r in enumerate(rows):
        raw = r[1].encode("utf-8", "surrogatepass")
        raw = (raw * (TRAIN_BYTES // len(raw) + 1))[:TRAIN_BYTES]
        codes[i] = np.frombuffer(raw, np.uint8)
    labels = np.array([langs.index(r[0]) for r in rows])
    return BiGru(langs).fit(codes, labels)


def predict_udf(spark, model: BiGru):
    shared = spark.sparkContext.broadcast(model)  # a few thousand numbers

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        m = shared.value
        p = m.documents(texts.tolist())
        best = p.argmax(axis=1)
        return pd.DataFrame({"lang_pred": [m.langs[i] for i in best],
                             "score": np.clip(p[np.arange(len(p)), best], 0, 1)})

    return predict


def language_id(docs: DataFrame, model: BiGru | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of ``docs``."""
    spark = prepare(docs.sparkSession)
    mod, rest = HELD_OUT
    if model is None:
        model = train(docs)
    held = (crc_mod(F.col("doc_id"), mod) == rest).alias("held_out")
    if model is None:
        return docs.select("doc_id", held, F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    p = docs.select("doc_id", held, F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("_letters"),
                    predict_udf(spark, model)("text").alias("_p"))
    return p.select("doc_id", "held_out",
                    F.when(F.col("_letters"), F.col("_p.lang_pred")).otherwise("und").alias("lang_pred"),
                    F.when(F.col("_letters"), F.col("_p.score")).otherwise(0.0).alias("score"))


def op3_language_id(spark, sf_dir):
    return language_id(documents(spark, sf_dir).select("doc_id", "text", "lang"))
