"""Operators 1 and 2 against brute force."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidemark.llm import quality_rules as Q
from tidemark.llm import simhash_dedup as S
from tidemark.llm.common import components

from llm_help import SF, plain


def slow_stats(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines, seen, dup = text.split("\n"), set(), 0
    for x in lines:
        if re.search(r"[^\x20\x09-\x0D]", x):
            dup += x in seen
            seen.add(x)
    grams = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) if grams[tuple(words[i:i + 5])] > 1 for k in range(5)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


def test_text_stats_equal_brute_force(spark, odd):
    texts = [r.text for r in odd.collect()] + [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").limit(80).collect()]
    rnd = random.Random(1)
    texts += [" ".join(rnd.choice("abc") for _ in range(rnd.randrange(30))) for _ in range(200)]
    for t in texts:
        assert Q.text_stats(t) == slow_stats(t), t


def test_host_rates_are_shrunk_and_joined_back(spark):
    good, bad = "one two three four five six seven eight nine ten eleven", "short"
    rows = [(i, good, "good") for i in range(40)] + [(100 + i, good if i % 10 == 0 else bad, "bad") for i in range(40)]
    rows += [(200, bad, "tiny"), (201, good, None), (202, good, None)] + [(300 + i, good, f"h{i}") for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r for r in Q.quality_rules(df).collect()}
    assert len(got) == len(rows)
    assert all(got[i].kept for i in range(40)) and got[201].kept and got[300].kept
    assert not got[100].base_failed and not got[100].kept  # its host is rejected
    # the empirical prior: moments of the hosts' rates
    hosts = defaultdict(list)
    for i, t, s in rows:
        hosts[s].append(t == bad)
    rates = [np.mean(v) for v in hosts.values()]
    k = max(np.mean(rates) * (1 - np.mean(rates)) / np.var(rates) - 1, 1)
    want = (1 + np.mean(rates) * k) / (1 + k)
    assert abs(got[200].shrunk_rate - want) < 1e-9 < want < 1
    assert plain(Q.rejected_rows_removed(df), "doc_id") == sorted(((i,) for i, r in got.items() if r.kept), key=repr)


def test_quality_rules_odd_input(odd, none):
    r = Q.quality_rules(odd)
    assert r.count() == odd.count() and "text" not in r.columns
    empty = [x for x in r.collect() if x.doc_id in (4, 5, 6)]
    assert all(x.n_words == 0 and x.base_failed and not x.kept for x in empty)
    kept = Q.rejected_rows_removed(odd)
    assert kept.columns == odd.columns and kept.filter("doc_id is null").count() in (0, 2)
    assert Q.quality_rules(none).count() == 0 and Q.rejected_rows_removed(none).count() == 0


def slow_simhash(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def slow_groups(docs):
    """doc index -> smallest id reachable, by all pairs of fingerprints."""
    fps = sorted({f for _, f in docs})
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(fps):
        for b in fps[i + 1:]:
            if (a ^ b).bit_count() <= 4:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    low = {}
    for d, f in docs:
        if d is not None:
            low[find(f)] = min(d, low.get(find(f), d))
    return [(d, f, low.get(find(f))) for d, f in docs]


def test_simhash_and_components_equal_brute_force(spark, odd):
    ev = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    base = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon " * 6
    rnd = random.Random(2)
    near = []
    for i in range(60):  # chains of small edits
        w = base.split()
        for _ in range(i % 4):
            w[rnd.randrange(len(w))] = f"edit{rnd.randrange(9)}"
        near.append((5000 + i, " ".join(w)))
    docs = ev.unionByName(spark.createDataFrame(near, "doc_id long, text string")).unionByName(odd.select("doc_id", "text"))
    got = S.near_duplicates(docs)
    want = slow_groups([(r.doc_id, slow_simhash(r.text)) for r in docs.collect()])
    as_rows = sorted(((r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in got.collect()), key=repr)
    assert as_rows == sorted(want, key=repr)
    one = S.one_per_group(docs)
    assert one.count() == len({f for *_, f in [(0, r.label) for r in got.collect()]})


@pytest.mark.parametrize("tile", [3, 4096])
def test_links_lose_no_pair_when_cells_are_tiled(spark, tile):
    rnd = random.Random(3)
    fps = set()
    for _ in range(12):
        c = rnd.getrandbits(64)
        for _ in range(25):
            x = c
            for _ in range(rnd.randrange(5)):
                x ^= 1 << rnd.randrange(64)
            fps.add(x - (1 << 64) if x >> 63 else x)
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    links = S.fingerprint_links(df, tile=tile)
    # a link is an edge of a spanning forest: it may join the ends of a chain of near fingerprints
    assert links.filter("src = dst").count() == 0
    got = defaultdict(set)
    for r in components(links).collect():  # a row for every node but the label itself
        got[r.label] |= {r.node, r.label}
    want = defaultdict(set)
    for d, f, low in slow_groups([(f, f & (1 << 64) - 1) for f in fps]):
        want[low].add(d)
    assert sorted(map(sorted, got.values())) == sorted(sorted(v) for v in want.values() if len(v) > 1)


def test_popcount_embedding_bounds_the_bit_distance(spark):
    rnd = random.Random(4)
    pairs = []
    for _ in range(300):
        a = rnd.getrandbits(64)
        b = a
        for _ in range(rnd.randrange(12)):
            b ^= 1 << rnd.randrange(64)
        pairs.append([x - (1 << 64) if x >> 63 else x for x in (a, b)])
    df = spark.createDataFrame(pairs, "a long, b long")
    d = df.select(F.bit_count(S.unary_counts(F.col("a")).bitwiseXOR(S.unary_counts(F.col("b")))).alias("m"),
                  F.bit_count(F.col("a").bitwiseXOR(F.col("b"))).alias("h"), "a", "b").collect()
    for r in d:
        counts = [[(x >> 2 * i & 3).bit_count() for i in range(32)] for x in (r.a, r.b)]
        assert r.m == sum(abs(x - y) for x, y in zip(*counts)) <= r.h


def test_dedup_odd_input(odd, none):
    one = S.one_per_group(odd)
    assert one.columns == odd.columns
    ids = plain(one, "doc_id")
    assert ids.count((8,)) <= 2 and (1,) in ids and (2,) not in ids and (4,) in ids and (5,) not in ids
    assert S.near_duplicates(none).count() == 0 and S.one_per_group(none).count() == 0
