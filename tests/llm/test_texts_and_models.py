"""Operators 3, 5, 8, 9 and 10: held-out accuracy, brute force, and the public library."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import katz as K
from tidemark.llm import language_id as L
from tidemark.llm import quality_classifier as B
from tidemark.llm import text_features as X
from tidemark.llm import token_counts as N
from tidemark.llm import toxicity as T

from llm_help import SF, plain


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def auc(score, y):
    """Share of (positive, negative) pairs in the right order, ties half."""
    score, y = np.asarray(score, float), np.asarray(y)
    a, b = score[y == 1], score[y == 0]
    return ((a[:, None] > b[None, :]) + 0.5 * (a[:, None] == b[None, :])).mean()


def remainder(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


def test_language_of_held_out_documents(docs):
    lang = {r.doc_id: r.lang for r in docs.collect()}
    got = L.language_id(docs).collect()
    assert len(got) == len(lang) and all(r.held_out == (remainder(r.doc_id, 3) == 1) for r in got)
    seen = [r for r in got if r.held_out and lang[r.doc_id] is not None and r.lang_pred != "und"]
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in seen]) > 0.85
    assert all(0 <= r.score <= 1 for r in got)


def test_bptt_gradient_learns_and_pools_whole_texts():
    rng = np.random.default_rng(1)
    codes = np.concatenate([rng.integers(97, 105, (60, 48)), rng.integers(110, 120, (60, 48))]).astype(np.uint8)
    m = L.BiGru(["a", "b"]).fit(codes, np.repeat([0, 1], 60))
    long = "abcdefgh" * 400
    p = m.documents([long, "npqrst" * 9, "", None])
    assert p[0].argmax() == 0 and p[1].argmax() == 1 and not p[2:].any()
    # the pooled probabilities are the mean over all positions of all segments
    raw = np.frombuffer(long.encode(), np.uint8)
    begin = np.arange(0, len(raw), L.SEGMENT)
    sums = m.segment_sums(raw, begin, np.minimum(L.SEGMENT, len(raw) - begin))
    assert np.allclose(p[0], sums.sum(axis=0) / len(raw))


def test_places_by_table_equal_the_rule():
    rng = np.random.default_rng(4)
    number = np.concatenate((rng.integers(3, K.HOT + 200, 300), rng.integers(1 << 63, 1 << 64, 300, np.uint64),
                             [K.END, K.START, K.NONE]), dtype=np.uint64, casting="unsafe")
    p = K.Places(number, 7, 53)
    a, b = rng.integers(0, 600, 5000), rng.integers(0, 600, 5000)
    assert (p.pairs(a, b) == K.places(number[a], number[b], 7, 53)).all()
    none = np.full(len(number), K.NONE, np.uint64)
    assert (p.words == K.places(none, number, 7, 53)).all()


def test_steps_between_texts_give_the_texts_back():
    rng = np.random.default_rng(5)
    texts = [np.sort(rng.choice(60_000, n, replace=False)).astype(np.uint16) for n in rng.integers(1, 9, 200)]
    step = np.concatenate([np.diff(t, prepend=np.uint16(0)).astype(np.uint16) for t in texts])
    held = np.array([len(t) for t in texts], np.uint32)
    assert (K.texts_of(held, step) == np.concatenate(texts)).all()


def test_steps_of_sorted_pairs_give_them_back():
    rng = np.random.default_rng(4)
    a = np.sort(np.concatenate((rng.integers(0, 6, 300), rng.integers(1 << 63, 1 << 64, 40, np.uint64)), dtype=np.uint64, casting="unsafe"))
    b = np.concatenate((rng.integers(0, 9, 170), rng.integers(1 << 63, 1 << 64, 170, np.uint64)), dtype=np.uint64, casting="unsafe")
    order = np.lexsort((b, a))
    for n in (340, 1, 0):
        x, y = a[order][:n], b[order][:n]
        back = K.stepped(*K.steps(x, y))
        assert (back[0] == x).all() and (back[1] == y).all() and len(back[0]) == n


def test_packed_columns_come_back():
    cols = [np.array([0, 255, 256, 1 << 63], np.uint64), np.array([-1, 5, 0], np.int64), np.empty(0, np.uint16),
            np.array([0.5, -2.0]), np.array([7, 70_000], np.uint32), np.zeros(3, np.int64)]
    got = K.unpack(K.pack(*cols), "<u8 <i8 <u2 <f8 <u4 <i8")
    assert all((g == c).all() and g.dtype == c.dtype for g, c in zip(got, cols))


def test_one_number_and_plain_sort_give_the_same_order():
    rng = np.random.default_rng(2)
    cols = [rng.integers(0, n, 5000).astype(t) for n, t in ((7, np.int32), (40, np.int32), (40, np.int32), (90, np.uint16))]
    for x, y in zip(K.in_order(*cols, 7, 40, 90), K.in_order(*cols, 7, 1 << 27, 90)):
        assert (x == y).all() and x.dtype == y.dtype


def test_numbers_of_common_and_other_words():
    words = [b"a", b"b", b"c"]
    h = [K.word_hash(w) for w in words]
    got = K.Numbering([h[2], h[0]]).numbers(words)
    assert got.tolist() == [K.END + 2, h[1] | 1 << 63, K.END + 1]
    assert K.Numbering([]).numbers(words).tolist() == [x | 1 << 63 for x in h]


def test_a_key_per_partition(spark):
    keys = K.partition_keys(spark, 13)
    got = spark.createDataFrame([(k,) for k in keys], "k int").repartition(13, "k").select("k", F.spark_partition_id().alias("p"))
    assert len(set(keys)) == 13 and sorted(r.p for r in got.collect()) == list(range(13))


def test_bptt_gradient_equals_finite_differences():
    rng = np.random.default_rng(2)
    m = L.BiGru(["a", "b", "c"], hidden=5)
    for params in (m.out, m.fwd.p, m.bwd.p):
        for k in params:
            params[k] = params[k].astype(np.float64)
    codes, labels = rng.integers(97, 110, (9, 4)).astype(np.uint8), np.array([0, 2, 1, 0])
    _, grads = m.gradients(codes, labels)
    for params, g in grads:
        for name, value in g.items():
            order = np.argsort(-np.abs(value), axis=None)  # the largest entries and some at random
            for flat in [*order[:6].tolist(), *rng.integers(0, value.size, 4).tolist()]:
                at = np.unravel_index(flat, value.shape)
                kept, eps, loss = params[name][at], 1e-6, []
                for step in (eps, -eps):
                    params[name][at] = kept + step
                    loss.append(m.gradients(codes, labels)[0])
                params[name][at] = kept
                assert abs((loss[0] - loss[1]) / (2 * eps) - value[at]) < 1e-5, (name, at)


def test_a_training_sample_is_bounded_before_it_is_ranked(spark, monkeypatch):
    monkeypatch.setattr(L, "PER_LANG", 20)
    df = spark.range(6000).select("id", F.concat(F.lit("some words "), F.col("id")).alias("text"),
                                  F.lit("en").alias("lang")).withColumnRenamed("id", "doc_id")
    got = L.training_segments(df)
    assert got.count() == 20 * L.PIECES and got.filter("piece not like '%s%'").count() < 20 * L.PIECES


def test_toxicity_features_by_hand():
    f = dict(zip(X.NAMES, X.Features({"idiot": 3.0}).row("You IDIOT you are\nnot an 1d!ot friend")))
    g = dict(zip(X.NAMES, X.Features({"idiot": 3.0}).row("They praise the friend\nof a kind neighbour")))
    names = list(X.NAMES)
    plain_ = X.Features({"idiot": 3.0}).row
    assert len(plain_("")) == len(plain_(None)) == len(names)
    assert plain_("") == plain_(None) and f != g
    assert sum(x > y for x, y in zip(f.values(), g.values())) >= 6  # hits, weight, second person, nearness, capitals, hidden


def test_every_language_keeps_training_pieces(spark, monkeypatch):
    monkeypatch.setattr(L, "MAX_SEGMENTS", 36)
    rows = [(1000 * k + i, f"some words of text {i}", f"l{k}") for k in range(5) for i in range(30)]
    rare = next(i for i in range(9000, 9100) if remainder(i, 3) != 1)
    df = spark.createDataFrame(rows + [(rare, "a text of its own", "rare")], "doc_id long, text string, lang string")
    got = Counter(r.lang for r in L.training_segments(df).collect())
    assert got == {"rare": 3, **{f"l{k}": 6 for k in range(5)}}


def test_language_odd_input(odd, none):
    got = L.language_id(odd)
    assert got.count() == odd.count()
    assert all(r.lang_pred == "und" and r.score == 0 for r in got.collect() if r.doc_id in (4, 5, 6, 10))
    assert L.language_id(none).count() == 0
    bare = L.language_id(odd.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in bare.collect()} == {"und"}


@pytest.mark.parametrize("run,label,mark,least", [(T.toxicity, "toxic", 0.5, 0.8), (B.quality, "quality", 0.3, 0.6)])
def test_classifiers_rank_held_out_documents(spark, run, label, mark, least):
    # the smallest tables hold too few labels of one kind to measure
    wide = spark.read.parquet(f"{SF.rsplit('/', 1)[0]}/sf0.01/documents.parquet")
    labels = spark.read.parquet(f"{SF.rsplit('/', 1)[0]}/sf0.01/labels.parquet")
    y = {r.doc_id: r[label] for r in labels.collect()}
    got = run(wide.select("doc_id", "text"), labels).collect()
    assert len(got) == wide.count()
    assert all(r.predicted == (r.score >= mark) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out and y.get(r.doc_id) is not None]
    assert all(remainder(r.doc_id, 5) == 0 for r in held)
    assert auc([r.score for r in held], [y[r.doc_id] for r in held]) > least


@pytest.mark.parametrize("run", [T.toxicity, B.quality])
def test_classifiers_odd_input(odd, none, labels, run):
    got = run(odd, labels)
    assert got.count() == odd.count() and got.filter("score is null or score < 0 or score > 1").count() == 0
    assert run(none, labels).count() == 0
    assert {r.score for r in run(odd, labels.limit(0)).collect()} == {0.0}


def test_held_out_labels_do_not_matter(odd, labels):
    flipped = labels.withColumn("toxic", F.when(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0,
                                                1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert plain(T.toxicity(odd, labels), "doc_id", "score") == plain(T.toxicity(odd, flipped), "doc_id", "score")


def test_isotonic_is_the_least_squares_monotone_fit():
    keys, fit = T.isotonic(np.array([1, 2, 2, 3, 4, 5.0]), np.array([0, 1, 0, 0, 1, 1]))
    assert keys.tolist() == [1, 2, 3, 4, 5] and (np.diff(fit) >= 0).all()
    assert np.allclose(fit, [0, 1 / 3, 1 / 3, 1, 1])


def test_trees_fit_an_interaction():
    x = np.random.default_rng(2).integers(0, 2, (400, 3)).astype(float)
    y = (x[:, 0] != x[:, 1]).astype(float)
    assert auc(T.Trees(x, y).raw(x), y) > 0.99


class SlowKatz:
    """Katz's model by dictionaries, evaluated token by token."""

    def __init__(self, texts):
        self.c1, self.c2 = Counter(), defaultdict(Counter)
        for t in texts:
            v = None
            for w in tokens(t):
                self.c1[w] += 1
                self.c2[v][w] += 1
                v = w
        self.n = sum(self.c1.values())
        self.ctx = {v: (len(texts) if v is None else self.c1[v]) for v in self.c2}
        of = Counter(self.c1.values())
        self.d1 = K.discounts(of)
        self.d2 = K.discounts(Counter(c for r in self.c2.values() for c in r.values()))
        mass = sum(c * self.d1.get(c, 1) for c in self.c1.values()) / self.n
        self.fix = 1.0 if mass < 1 - 1e-12 else self.n / (self.n + 1.0)
        self.unknown = 1 - mass * self.fix

    def word(self, w):
        c = self.c1[w]
        return c * self.d1.get(c, 1) * self.fix / self.n if c else self.unknown

    def p(self, v, w):
        kept = {x: c * self.d2.get(c, 1) / self.ctx[v] for x, c in self.c2.get(v, {}).items() if c >= K.MIN_PAIR}
        if not kept:
            return self.word(w)
        s, n = sum(kept.values()), self.ctx[v]
        f = (1 - 1 / (n + 1)) / s if 1 - s < 0.5 / (n + 1) else 1.0
        if w in kept:
            return f * kept[w]
        return (1 - f * s) / (1 - sum(map(self.word, kept))) * self.word(w)

    def score(self, t):
        v, s = None, 0.0
        for w in tokens(t):
            s += math.log10(self.p(v, w))
            v = w
        return s

    def base(self, t):
        v = len(self.c1)
        return sum(math.log10((self.c1[w] + 0.5) / (self.n + 0.5 * (v + 1))) for w in tokens(t))


END = object()


def tokens(t):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low) + [END]


def check_katz(df):
    rows = df.collect()
    slow = SlowKatz([r.text for r in rows if remainder(r.doc_id, 5) != 1])
    want = sorted(((str(r.doc_id), remainder(r.doc_id, 5) == 1, len(tokens(r.text)),
                    sum(slow.c1[w] > 0 for w in tokens(r.text)), slow.n, slow.base(r.text), slow.score(r.text))
                   for r in rows), key=lambda x: (x[0], x[2], x[5]))
    got = sorted(((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score)
                  for r in K.katz_scores(df).collect()), key=lambda x: (x[0], x[2], x[5]))
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:5] == w[:5] and np.allclose(g[5:], w[5:], rtol=1e-6, atol=1e-6), (g, w)
    return slow


def test_katz_equals_recursive_evaluation_and_sums_to_one(docs):
    slow = check_katz(docs.select("doc_id", "text"))
    for v in [None, *[w for w, _ in slow.c1.most_common(5)], next(iter(slow.c1))]:
        if v is not END:
            assert abs(sum(slow.p(v, w) for w in slow.c1) + slow.p(v, "never seen") - 1) < 1e-9


def test_katz_odd_input(odd, none):
    check_katz(odd.filter("doc_id is not null").select("doc_id", "text"))
    assert K.katz_scores(odd).count() == odd.count() and K.katz_scores(none).count() == 0
    got = K.katz_scores(odd.filter("doc_id = 4")).collect()
    assert [r.n_tokens for r in got] == [1]


def test_katz_chunks_of_equal_texts_are_summed_apart(spark, docs):
    # every partition is a chunk of one text, the same in several of them; then a table and its copy
    rows = [(i, t) for i, t in enumerate(["a b a c", "a b a c", "a b a c", None, None, "a b a c a b"])]
    check_katz(spark.createDataFrame(spark.sparkContext.parallelize(rows, len(rows)), "doc_id long, text string"))
    few = docs.select("doc_id", "text").limit(60).coalesce(1)
    check_katz(few.union(few))


def test_katz_keeps_pairs_seen_once(spark):
    x, y = K.END + 1, -5  # a common word and one known by its hash
    counts = [(K.NONE, x, 3, False), (K.NONE, y, 1, False), (x, x, 2, False), (x, y, 1, False), (y, x, 1, False)]
    grams, model = K.fit(spark.createDataFrame(counts, "a long, b long, c long, shared boolean"), 1)
    assert plain(grams, "a", "b", "c", "cb") == sorted(
        [(K.NONE, x, 3, 0), (K.NONE, y, 1, 0), (x, x, 2, 3), (x, y, 1, 1), (y, x, 1, 3)], key=repr)
    assert model.pairs == K.discounts({1: 2, 2: 1})
    assert K.MIN_PAIR == 1  # the brute force leaves no pair out
    check_katz(spark.createDataFrame([(i, t) for i, t in enumerate(["a b c", "a b d e", "d e", "c b a d", "e d", "b a"] * 2)],
                                     "doc_id long, text string"))


def library_counts(texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(str(public_tokenizers.path(N.TOKENIZER)))
    tok.no_truncation()
    tok.no_padding()
    return [len(tok.encode(t or "", add_special_tokens=False).ids) for t in texts]


def test_token_counts_equal_the_library(docs, odd, none):
    pytest.importorskip("public_tokenizers")
    both = docs.select("doc_id", "text").unionByName(odd.select("doc_id", "text"))
    rows = both.collect()
    want = sorted((str(r.doc_id), len((r.text or "").encode()), n, n > 512)
                  for r, n in zip(rows, library_counts([r.text for r in rows])))
    got = sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in N.token_counts(both).collect())
    assert got == want
    assert N.token_counts(none).count() == 0


def test_token_counts_on_hard_texts():
    pytest.importorskip("public_tokenizers")
    rnd = np.random.default_rng(10)
    signs = list("aAzé 漢😀'\n\t   ‍19.,!-_stmdrevl") + ["'ll", "'re", "<|endoftext|>", "  ", "\r\n"]
    texts = ["".join(rnd.choice(signs, rnd.integers(1, 60))) for _ in range(1500)]
    texts += ["a" * 5000, " " * 3000, "\n" * 2000 + "x", "ab" * 4000, "!?" * 700, "1" * 900, "the cat " * 3000]
    assert N.tokenizer(N.TOKENIZER).counts(texts).tolist() == library_counts(texts)


@pytest.mark.parametrize("run", [T.toxicity, B.quality])
def test_fits_do_not_depend_on_how_rows_are_dealt(spark, run):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    one = plain(run(docs.coalesce(1), labels), "doc_id", "score")
    assert one == plain(run(docs.repartition(5), labels.repartition(3)), "doc_id", "score")


def test_equal_texts_count_once_by_the_majority(spark):
    docs = spark.createDataFrame([(i, "same text here") for i in (2, 3, 4)] + [(7, "even text"), (8, "even text"), (9, None)],
                                 "doc_id long, text string")
    labels = spark.createDataFrame([(2, 0), (3, 1), (4, 0), (7, 1), (8, 0), (9, 1)], "doc_id long, quality int")
    got = {r.text: (r.label, r.doc_id) for r in X.labelled_sample(docs, labels, "quality", (5, 9), 100).collect()}
    assert got == {"same text here": (0, 2), "even text": (1, 7)}


def test_an_id_with_many_texts_does_not_pass_the_bound(spark):
    docs = spark.range(3000).select(F.lit(1).cast("long").alias("doc_id"), F.concat(F.lit("text "), F.col("id")).alias("text"))
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    assert 50 <= X.labelled_sample(docs, labels, "quality", (5, 9), 100).count() <= 160


def test_pair_weights_equal_plain_gradient_ascent():
    rng = np.random.default_rng(3)
    d = rng.normal(size=(300, 4)) + np.array([0.8, -0.4, 0.0, 0.2])
    w = np.zeros(4)
    for _ in range(20_000):
        w += 0.01 * B.pair_gradient(d, w)[0]
    assert np.abs(w - B.pair_weights(d, 50)).max() < 1e-4
    # the gradient is that of the penalised likelihood
    def value(v):
        return -np.log1p(np.exp(-(d @ v))).mean() * 100 - B.RIDGE * (v @ v) / 2
    for j in range(4):
        e = np.eye(4)[j] * 1e-5
        assert abs((value(w + 0.3 + e) - value(w + 0.3 - e)) / 2e-5 - B.pair_gradient(d, w + 0.3)[0][j]) < 1e-4
