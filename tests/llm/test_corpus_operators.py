"""Operators 4, 6, 7 and the pipeline against brute force and their contracts."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import decontaminate as D
from tidemark.llm import mixing as M
from tidemark.llm import queries, sharding
from tidemark.llm.common import documents
from tidemark.llm.simhash_dedup import one_per_group

from llm_help import SF, plain


@pytest.fixture(scope="module")
def docs(spark):
    return documents(spark, SF)


def test_lpt_takes_the_largest_first_to_the_least_loaded():
    placed = sharding.lpt([("a", 7), ("b", 5), ("c", 4), ("d", 4), ("e", 3), ("f", 1)], 3)
    assert placed == {"a": 0, "b": 1, "c": 2, "d": 2, "e": 1, "f": 0}


@pytest.mark.parametrize("heavy_parts,lots", [(1 << 14, 1 << 14), (8, 64)])
def test_shards_hold_groups_and_near_equal_bytes(docs, heavy_parts, lots):
    rows = sharding.with_shards(docs, heavy_parts=heavy_parts, lots=lots).collect()
    assert len(rows) == docs.count()
    home = defaultdict(set)
    load = Counter()
    for r in rows:
        home[r.text].add(r.shard)
        load[r.shard] += len((r.text or "").encode()) + 1
    assert all(len(s) == 1 for s in home.values()) and set(load) == set(range(8))
    if lots > 64:
        largest = max(sum(len((r.text or "").encode()) + 1 for r in rows if r.text == t) for t in home)
        assert max(load.values()) - min(load.values()) <= largest


def test_placement_equals_a_plain_heap(docs):
    """The table's shards are those of a heap over its items: groups of their own and lots."""
    parts, lots = 64, 32
    size = Counter()
    text_of = {}
    rows = sharding.with_shards(docs, heavy_parts=parts, lots=lots).withColumn("g", F.xxhash64("text")).collect()
    for r in rows:
        size[r.g] += len((r.text or "").encode()) + 1
        text_of[r.g] = r.text
    least = sum(size.values()) / parts
    items = Counter()
    for g, n in size.items():
        items[(0, g) if n >= least else (1, g % lots)] += n
    assert {k for k, _ in items} == {0, 1}
    load, home = [0] * 8, {}
    for key, n in sorted(items.items(), key=lambda x: (-x[1], x[0])):
        home[key] = min(range(8), key=lambda s: (load[s], s))
        load[home[key]] += n
    for r in rows:
        assert r.shard == home[(0, r.g) if size[r.g] >= least else (1, r.g % lots)]


def test_slots_follow_the_partitions(spark, docs):
    rows = sharding.shard_slots(sharding.with_shards(docs.repartition(7), 3)).collect()
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert sorted(slots) == [0, 1, 2] and all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_slots_are_gapless(spark):
    got = queries.QUERIES["op4_sharding"](spark, SF).collect()
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_sharding_odd_input(odd, none):
    got = sharding.sharded(odd)
    assert got.count() == odd.count() and got.columns[:-2] == [c for c in odd.columns if c not in ("shard", "slot")]
    assert len({r.shard for r in got.filter("doc_id in (1, 2)").collect()}) == 1
    assert sharding.sharded(none).count() == 0


def slow_hits(text, items):
    """item -> smallest edit distance to any stretch of the text, if allowed."""
    words = D.normal_words(text or "")
    out = {}
    for item, own in items.items():
        if len(own) < D.MIN_WORDS:
            continue
        row = [0] * (len(words) + 1)  # free begin and end in the text
        for i, w in enumerate(own, 1):
            prev, row = row, [i]
            for j, x in enumerate(words, 1):
                row.append(min(prev[j] + 1, row[j - 1] + 1, prev[j - 1] + (w != x)))
        if min(row) <= D.allowed(len(own)):
            out[item] = min(row)
    return out


def test_leaks_reach_recall_and_are_exact(spark):
    rnd = random.Random(5)
    vocab = [f"word{i}" for i in range(400)]
    items = {i: [rnd.choice(vocab) for _ in range(rnd.choice([6, 12, 25, 60]))] for i in range(40)}
    texts, planted = [], 0
    for d in range(120):
        w = [rnd.choice(vocab) for _ in range(rnd.randrange(20, 120))]
        if d % 2:
            x = list(items[d % 40])
            for _ in range(rnd.randrange(D.allowed(len(x)) + 1)):
                x[rnd.randrange(len(x))] = "other"
            at = rnd.randrange(len(w))
            w[at:at] = x
            planted += 1
        texts.append((d, " ".join(w).upper() + "."))
    bench = spark.createDataFrame([(i, " ".join(w), "x") for i, w in items.items()] + [(90, None, "x"), (91, "too short", "x")],
                                  "item_id long, text string, other string")
    df = spark.createDataFrame(texts, "doc_id long, text string")
    for block in (D.BLOCK_BYTES, 2000):  # one block of items, or several
        got = {(r.doc_id, r.item_id): r.distance for r in D.leaks(df, bench, block).collect()}
        coded = {i: [x.encode() for x in w] for i, w in items.items()}
        want = {(d, i): k for d, t in texts for i, k in slow_hits(t, coded).items()}
        assert len(want) >= planted and all(got[k] >= want[k] for k in got) and set(got) <= set(want)
        assert len(got) >= 0.95 * len(want)
    clean = {d for d, _ in texts} - {d for d, _ in got}
    assert {r.doc_id for r in D.uncontaminated(df, bench, 2000).collect()} == clean


@pytest.mark.parametrize("kind", ["missing", "added", "replaced"])
@pytest.mark.parametrize("n", [12, 40, 59, 80, 120])
def test_leaks_reach_recall_at_the_edit_bound(n, kind):
    rnd = random.Random(f"{n} {kind}")
    item = [f"item{i}" for i in range(n)]
    # a smaller item of the same size group fixes the length of its walks
    index = D.Index([(1, " ".join(item)), (2, " ".join(f"other{i}" for i in range(int(n / 1.2))))])
    texts = []
    for _ in range(150):
        x, at = list(item), rnd.sample(range(n), int(D.allowed(n)))
        if kind == "missing":
            x = [w for i, w in enumerate(x) if i not in at]
        elif kind == "replaced":
            x = [f"new{i}" if i in at else w for i, w in enumerate(x)]
        else:
            for i in at:
                x.insert(rnd.randrange(1, len(x)), f"new{i}")
        texts.append(" ".join(["before"] * 9 + x + ["after"] * 9))
    hits = index.search(texts)
    assert all(h[0] == 1 and h[3] <= D.allowed(n) for x in hits for h in x)
    assert sum(map(len, hits)) >= 0.96 * len(texts)


def test_leaks_odd_input(odd, none, spark):
    bench = spark.createDataFrame([(1, "the river runs under a stone bridge and the mill wheel turns")], "item_id long, text string")
    kept = D.uncontaminated(odd, bench)
    assert kept.columns == odd.columns
    assert {r.doc_id for r in kept.collect()} == {4, 5, 6, 7, 8, 9, 10, 12}
    assert D.leaks(none, bench).count() == 0 and D.leaks(odd, bench.limit(0)).count() == 0
    assert D.uncontaminated(odd, bench.limit(0)).count() == odd.count()


def slow_targets(sizes):
    """Targets by resharing the excess of capped sources until none is above."""
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}
    fixed, free = {}, set(order)
    while free:
        rest = sum(sizes.values()) - sum(fixed.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        above = {s for s in free if share[s] > 3 * sizes[s] + 1e-9}
        if not above:
            return fixed | share
        fixed |= {s: 3.0 * sizes[s] for s in above}
        free -= above
    return fixed


def test_mix_meets_targets_and_reruns_agree(docs):
    got = M.mixed_quantities(docs).collect()
    source = {r.doc_id: r.source for r in docs.collect()}
    sizes, taken, target = Counter(), Counter(), {}
    for r in got:
        sizes[source[r.doc_id]] += r["size"]
        taken[source[r.doc_id]] += r.taken
        target[source[r.doc_id]] = r.target
        assert 0 <= r.taken <= 3 * r["size"]
    for s, t in slow_targets(dict(sizes)).items():
        assert abs(target[s] - t) < 1e-6 * max(t, 1) and abs(taken[s] - t) <= 1
    again = M.mixed_quantities(docs.repartition(5))
    assert plain(again, "doc_id", "taken", "shard") == sorted(((r.doc_id, r.taken, r.shard) for r in got), key=repr)


def test_quota_tree_is_exact():
    q = np.array([5, 0, 17, 40, 1])
    out = M.split_quotas(q, 8, np.random.default_rng(1))
    assert (out.sum(axis=1) == q).all() and out.sum(axis=0).max() - out.sum(axis=0).min() <= 1 and (out >= 0).all()
    mean = np.mean([M.split_quotas(q, 4, np.random.default_rng(i)) for i in range(800)], axis=0)
    assert np.abs(mean - q[:, None] * np.array([16, 16, 16, 15]) / 63).max() < 0.25  # the law's mean, by room


def test_mixing_odd_input(odd, none):
    got = M.mixed_quantities(odd)
    assert got.count() == odd.count() and got.filter("size = 0 and taken > 0").count() == 0
    rows = M.mixed_documents(odd)
    assert rows.columns == odd.columns and rows.filter("text is null").count() == 0
    assert M.mixed_quantities(none).count() == 0 and M.mixed_documents(none).count() == 0


def test_water_level_equals_a_sorted_sweep(spark):
    rnd = random.Random(9)
    for n, want in ((1, 5.0), (40, 900.0), (200, 90.0), (60, 1e9), (5, 0.0)):
        rows = [(float(rnd.choice([1, 2, 3])), float(rnd.choice([0, 1, 7, 30, 30, rnd.randrange(60)]))) for _ in range(n)]
        turns = sorted({c / w for w, c in rows})
        got = M._water_level(spark.createDataFrame(rows, "w double, cap double"), want, sum(w for w, _ in rows), bins=3)
        reached = sum(min(c, w * got) for w, c in rows)
        assert abs(reached - min(want, sum(c for _, c in rows))) < 1e-6 and got <= turns[-1] + 1e-9


def test_every_take_of_a_block_has_a_place_of_its_own(spark):
    """Quotas are takes (epochs x blocks + partial), the shards' bounds partition them exactly and evenly."""
    rows = [(s, b, e * 10 + x, e, x) for s, (e, cut) in enumerate([(2, 5), (0, 9), (3, 0), (1, 12)])
            for b in range(12) for x in [1 if b < cut else 0]]
    drawn = spark.createDataFrame(rows, "sid long, block long, taken long, epochs long, extra long")
    shards = 5
    got = {(r.sid, r.block): r.shards for r in M._with_shards(drawn, shards).collect()}
    count, per_source = Counter(), defaultdict(Counter)
    for s, b, taken, e, x in rows:
        assert len(got[s, b] or []) == e + x
        for k in got[s, b] or []:
            count[k] += 1
            per_source[s][k] += 1
    total = sum(r[3] + r[4] for r in rows)
    assert sum(count.values()) == total and max(count.values()) - min(count.values()) <= 1 and len(count) == shards
    # the same quotas, split by the bounds: running sums of each source's row of the table
    quota = spark.createDataFrame([(s, sum(c.values())) for s, c in per_source.items()], "sid long, quota long")
    for r in M.shard_bounds(quota, shards).collect():
        assert [b - a for a, b in zip([0, *r.bounds], r.bounds)] == [per_source[r.sid][k] for k in range(shards)]


def test_copies_of_a_document_go_to_the_shards_of_their_takes(spark):
    rows = [(i, "a b c", f"s{i % 4}" if i % 40 else "small") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    want = {r.doc_id: (r.taken // r.size, r.shards) for r in M.mixed_quantities(docs).collect()}
    assert max(n for n, _ in want.values()) == 3 and any(len(set(s)) > 1 for n, s in want.values() if n > 1)
    got = Counter(r.doc_id for r in M.mixed_documents(docs).collect())
    assert all(abs(got[d] - n) <= 1 and len(s or []) >= n for d, (n, s) in want.items())


def test_pipeline_equals_its_stages(spark, docs):
    out = corpus_pipeline.run(spark, SF)
    kept = docs
    for name, stage in corpus_pipeline.STAGES:
        before, kept = kept, stage(spark, kept, SF)
        if name != "sharding":
            assert kept.columns == docs.columns
        if name != "mixing":
            assert kept.count() <= before.count()
    assert plain(out, "doc_id", "text", "shard") == plain(kept, "doc_id", "text", "shard")
    assert out.count() > 0.8 * docs.count()


def test_pipeline_stages_on_odd_tables(spark, odd, none):
    for table in (odd, none):
        rows = table
        for _, stage in corpus_pipeline.STAGES[:-1]:
            rows = stage(spark, rows, SF)
            assert rows.columns == table.columns
        corpus_pipeline.sharding(spark, rows, SF).count()
    assert one_per_group(none).count() == 0


def test_pipeline_removes_what_it_should(spark, docs):
    kinds = {r.doc_id for r in queries.QUERIES["op6_decontamination"](spark, SF).collect()}
    out = {r.doc_id for r in corpus_pipeline.run(spark, SF).collect()}
    assert kinds and not kinds & out


def test_every_operator_is_registered():
    assert [int(n[2:].split("_")[0]) for n in queries.QUERIES] == list(range(1, 14))
