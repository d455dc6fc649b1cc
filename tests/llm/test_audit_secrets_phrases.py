"""Operators 11 to 13 against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest
from llm_help import SF

from tidemark.llm import filter_audit as A
from tidemark.llm import phrases as P
from tidemark.llm import secret_scan as S

SPACE = "[^\x20\x09-\x0D]+"


def slow_flags(rows):
    """(part, failing letters) per (doc_id, text, lang)."""
    low = {}
    for i, t, _ in rows:
        if i is not None:
            low[t or ""] = min(i, low.get(t or "", i))
    out = []
    for i, t, lang in rows:
        t = t or ""
        w = re.findall(SPACE, t)
        f = "A" * (len(w) < 100) + "B" * (100 * len(set(w)) < 80 * len(w))
        f += "C" * (100 * len(re.findall("[A-Z]", t)) > 10 * len(t)) + "D" * bool(re.search("[#$%&*|]", t))
        out.append((i, lang or "", f + "E" * (i is not None and low[t] < i)))
    return out


def slow_audit(rows, labels):
    good, toxic = defaultdict(int), defaultdict(int)
    for i, q, x in labels:
        good[i] |= q == 1
        toxic[i] |= x == 1
    good[None] = toxic[None] = 0
    docs = slow_flags(rows)
    want, shapley = {}, Counter()
    for part in {p for _, p, _ in docs}:
        mine = [(f, good[i], toxic[i]) for i, p, f in docs if p == part]
        for order in map("".join, permutations("ABCDE")):
            left = mine
            for k, c in enumerate(order):
                out = [d for d in left if c in d[0]]
                before = [d for d in mine if c in d[0] and set(d[0]) & set(order[:k])]
                left = [d for d in left if c not in d[0]]
                shapley[part, c] += len(out)
                want[part, order, k + 1] = [len(left), len(out), len(before), sum(d[0] == c for d in mine),
                                            sum(d[1] for d in out), sum(d[2] for d in out)]
    return {k: v + [shapley[k[0], k[1][k[2] - 1]]] for k, v in want.items()}


def audit_rows(df):
    return {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost,
                                               r.shapley] for r in df.collect()}


def test_audit_equals_brute_force(spark, odd, none, labels):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    both = docs.unionByName(odd.select("doc_id", "text", "lang"))
    rows = [tuple(r) for r in both.collect()]
    want = slow_audit(rows, [tuple(r) for r in labels.select("doc_id", "quality", "toxic").collect()])
    assert audit_rows(A.filter_audit(both.repartition(5), labels)) == want
    assert len(want) == 600 * len({r[2] or "" for r in rows})
    assert A.filter_audit(odd, labels).count() == 600 * len({r[2] or "" for r in odd.select("doc_id", "text", "lang").collect()})
    assert A.filter_audit(none, labels).count() == 0


def test_matrix_has_one_column_per_word_in_all_shards(spark, odd):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").unionByName(
        odd.select("doc_id", "text", "lang")).repartition(4)
    text_of = {hashlib.sha256((r.text or "").encode()).digest(): r.text or "" for r in docs.collect()}
    shards = A.term_matrix(docs).collect()
    assert len(shards) == 4
    counts, at = Counter(), defaultdict(set)  # column -> words of the same count in the same document
    for s in shards:
        indptr, cols = np.frombuffer(s.indptr, "<i8"), np.frombuffer(s.indices, "<i8")
        data = np.frombuffer(s.data, "<i4")
        for r, d in enumerate(s.digest):
            words = Counter(w.encode() for w in re.findall(SPACE, text_of[bytes(d)]))
            row = slice(indptr[r], indptr[r + 1])
            assert sorted(data[row].tolist()) == sorted(words.values()) and (np.diff(cols[row]) > 0).all()
            for c, n in zip(cols[row].tolist(), data[row].tolist()):
                options = {w for w, k in words.items() if k == n}
                at[c] = at[c] & options if c in at else options
                assert at[c]  # one word is left for the column in every document
                counts[c] += n
    total = Counter(w.encode() for t in docs.collect() for w in re.findall(SPACE, t.text or ""))
    assert sorted(counts.values()) == sorted(total.values())


def test_matrix_and_flags_share_one_worker_per_task(spark, odd, monkeypatch):
    plans = {}
    staged = A.staged

    def seen(df, name, *more):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return staged(df, name, *more)

    monkeypatch.setattr(A, "staged", seen)
    docs = odd.select("doc_id", "text", "lang").repartition(2)
    got = A.document_flags(docs)
    steps = re.findall(r"MapInArrow (\w+)\(", plans["flags"])
    assert sorted(steps) == ["columns", "numbered_words"]  # a step on its own would be a second worker per task
    # rows made beside the shards are those made from the finished shards
    beside = A.term_matrix(docs, each=A._row_flags, schema=A.FLAGS).collect()
    after = A.term_matrix(docs).mapInArrow(A._row_flags, A.FLAGS).collect()
    assert len(beside) == odd.count() == got.count() and sorted(map(repr, beside)) == sorted(map(repr, after))


def test_tasks_give_memory_back_when_they_end(monkeypatch):
    class Task:
        @staticmethod
        def get():
            return Task

        @staticmethod
        def partitionId():
            return 0

    class Pool:
        released = 0

        @classmethod
        def release_unused(cls):
            cls.released += 1

    monkeypatch.setattr(A, "TaskContext", Task)
    texts = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array(["en", "en"]), pa.array([b"b a", b"a"])],
                                       names=["doc_id", "part", "text"])
    words = pa.RecordBatch.from_arrays([pa.array([b"a", b"b"]), pa.array([0, 0]), pa.array([1, 0], pa.int32())],
                                       names=["word", "shard", "code"])
    monkeypatch.setattr(pa, "default_memory_pool", lambda: Pool)
    for task, batch in ((A.local_shards, texts), (A.numbered_words, words)):
        before = Pool.released
        assert [b.num_rows for b in task([batch])] == [1]
        assert Pool.released == before + 1


def slow_plain(text):
    out = []
    for m in re.finditer(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                         text or "", re.ASCII):
        if len(m[2]) >= 6:
            out.append((m.start(), 0, m.end()))
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text or "") if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text or "") if len(m[0]) >= 24]
    return ",".join(f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in sorted(out))


def test_plain_spans_equal_the_patterns(spark, odd, none):
    rnd = random.Random(5)
    bits = ["token", "PassWord", "api_key", "API", "key", "=", ":", " ", "'", '"', "AKIA", "ABCD1234", "deadbeef", "é", "\n",
            "secret", "x", "0123456789abcdef", "ſecret", "toKen", "=="]
    texts = ["".join(rnd.choice(bits) for _ in range(rnd.randrange(40))) for _ in range(3000)]
    for t in texts:
        got = S.all_spans(t)
        assert ",".join(f"{k}:{s}:{e}" for k, s, e, _, _ in got if k != "literal") == slow_plain(t), t
        assert got == sorted(got, key=lambda x: (x[1], S.KINDS.index(x[0])))
    docs = odd.select("doc_id", "text").unionByName(spark.createDataFrame(list(enumerate(texts[:50])), "doc_id long, text string"))
    rows = S.secret_spans(docs).collect()
    want = sorted(slow_plain(r.text) for r in docs.collect())
    assert sorted(",".join(f"{s.kind}:{s.start}:{s.end}" for s in r.spans if s.kind != "literal") for r in rows) == want
    assert S.secret_spans(none).count() == 0


@pytest.mark.parametrize("text, literals", [
    ('A = "Zx81-kkq9-LL"\nB = A\nconnect(user="bob", password=B)', ["Zx81-kkq9-LL"]),
    ("export TOK=abc123def456\nAPI_TOKEN=${TOK}\n", ["abc123def456"]),
    ('cfg["client_secret"] = "pa" + "rt9two"', ["pa", "rt9two"]),
    ('{"userName": "joe", "privateKey": "MIIB9xyz77"}', ["MIIB9xyz77"]),
    ('db_password: str = "q1w2e3r4t5!"', ["q1w2e3r4t5!"]),
    ("<password>hunt3r22xx</password>", ["hunt3r22xx"]),
    ("signing-key: abcd-1234-efgh # rotate\nfoo: bar", ["abcd-1234-efgh"]),
    ("private_key:\n  'abcd1234efgh'", ["abcd1234efgh"]),
    ('const k = "v3ryS3cret"; login({ password: k, user: "x" });', ["v3ryS3cret"]),
    ('password = X\nX = "l4ter-b0und"', ["l4ter-b0und"]),
    ('X = "f1rst-val"\npassword = X\nX = "s3cond-val"', ["f1rst-val"]),
    # nothing secret: other names, descriptions of secrets, placeholders, calls, cycles, prose
    ('user = "q1w2e3r4t5"', []), ('password_hint = "b0rn in 1970"', []), ('password = "changeme123"', []),
    ("password = get_it()", []), ("secret_a = secret_b\nsecret_b = secret_a", []),
    ("The key: it's a plain sentence, don't you think? The token = none", []),
    ("the token of love is a key: nothing more, 'nothing less'", []),
])
def test_literals_are_scored_by_their_targets(text, literals):
    assert [text[s:e] for k, s, e, *_ in S.all_spans(text) if k == "literal"] == literals


def slow_phrases(rows, least, top):
    count, total = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = lang or "und"
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(w)
            for k in range(1, 6):
                for i in range(len(w) - k + 1):
                    count[lang][tuple(w[i:i + k])] += 1
    out = []
    for lang, f in count.items():
        many = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inside = set()
        for p, a in many.items():
            for i in range(len(p)):
                for j in range(i + 2, len(p) + 1):
                    if j - i < len(p) and 100 * a >= 100 * f[p[i:j]]:
                        inside.add(p[i:j])
        found = []
        for p, a in many.items():
            if p not in inside:
                s, k = min((1000 * a * total[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                found.append((-s, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, l, r, total[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(found)[:top])]
    return sorted(out)


def got_phrases(df):
    return sorted((r.lang, r.rank, r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect())


@pytest.mark.parametrize("least, top, share", [(3, 2000, 1 / 8), (3, 25, 1 / 8), (4, 5, 1 / 2)])
def test_phrases_equal_brute_force(spark, odd, least, top, share):
    rnd = random.Random(6)
    common = [f"w{i}" for i in range(8)]
    rare = ["alpha beta gamma delta epsilon zeta", "Éa öb漢", "p q p q p", "one two three"]
    rows = []
    for i in range(120):
        words = [rnd.choice(rare) if rnd.random() < 0.15 else rnd.choice(common) for _ in range(40)]
        rows.append((rnd.choice([" ", "  ", "\t", ", ", "\n", " \x0b"]).join(words), [None, "en", "xx", "und"][i % 4]))
    docs = spark.createDataFrame(rows, "text string, lang string").unionByName(odd.filter("length(text) < 9999").select("text", "lang"))
    want = slow_phrases([tuple(r) for r in docs.collect()], least, top)
    assert got_phrases(P.collocations(docs.repartition(3), least, top=top, share=share)) == want and len(want) > 10


def test_phrases_odd_input(odd, none):
    assert P.collocations(none, 2).count() == 0
    got = got_phrases(P.collocations(odd, 100))
    assert got == slow_phrases([tuple(r) for r in odd.select("text", "lang").collect()], 100, 2000)
