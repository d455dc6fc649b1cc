"""Operator 7 - mixing sources to target weights with exact block quotas.

Targets: sources in code-point order (null last) weigh ``weights`` repeating
and share all words; a target stops at ``max_repeat`` times its source and the
excess is shared again by weight until none is above (a water level found by a
few aggregations over the table of sources).

Draw: a document falls by a keyed hash into one of ``BLOCKS`` blocks of its
source; the hash order is a random permutation of the blocks.  A source gives
its whole epochs floor(target / size) times and, of one more epoch, the first
blocks of the permutation until the target is met.  The block that straddles
the target is cut again into sub-blocks, and its last sub-block by document,
so no step gathers a source.

Output shards: the number of takes of blocks of every source (its quota: all its
blocks in each whole epoch, and those of the partial one) is
partitioned exactly among the shards by a splitting tree: each node splits its
quotas between its two halves by one multivariate-hypergeometric draw.
Sources are summed into at most ``STRATA`` strata for the tree on the driver;
inside a stratum the same tree splits the strata's shares among its sources as
a distributed job (the conditional law is again hypergeometric, so the joint
draw is exact).  The takes of a source, epoch by epoch and each in permuted order,
fill the shards' quotas without overlap: every copy of a document has a shard of
its own, and rows are shuffled inside their shard by hash.

Defined results: null and wordless texts have size 0 and are taken 0 words;
sources of size 0 have target 0; a null source is a source of its own; equal
rows (same id, text) fall together and ties in the last sub-block go by id;
an empty table gives an empty result.  Nothing depends on partitioning: reruns
agree.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import documents, prepare, shuffle_width, staged, word_count

WEIGHTS = (1, 2, 3)
MAX_REPEAT = 3
BLOCKS = 4096
STRATA = 1024
SEED = 20817


def _ordered_sources(sizes: DataFrame) -> DataFrame:
    """Sources with ``sid``, their 0-based rank by code point, null last.

    Range-partitioned and staged, then numbered inside each partition and
    shifted by the partitions before it (one number each on the driver).
    """
    spark = sizes.sparkSession
    order = [F.col("source").asc_nulls_last()]
    n = shuffle_width(spark)
    t = staged(sizes.repartitionByRange(n, *order).withColumn("_p", F.spark_partition_id()), "sources")
    counts = sorted((r["_p"], r["count"]) for r in t.groupBy("_p").count().collect())  # <= n rows
    offset, rows = 0, []
    for p, c in counts:
        rows.append((p, offset))
        offset += c
    offs = spark.createDataFrame(rows, "_p int, _off long")
    w = Window.partitionBy("_p").orderBy(*order)
    return (t.withColumn("_rn", F.row_number().over(w)).join(F.broadcast(offs), "_p")
             .select("source", "source_size", (F.col("_off") + F.col("_rn") - 1).cast("long").alias("sid")))


def _water_level(s: DataFrame, want: float, free: float, bins: int = 1024) -> float:
    """The level at which the sum of min(cap, w * level) over rows (w, cap) is ``want``.
    ``free`` is the sum of w.

    A source is capped where the level passes its turn, cap / w.  The level is
    enclosed by a histogram of the turns, then by one of the bin it lies in, until
    it lies between two turns: a few jobs, each returning at most ``bins`` rows.
    """
    s = s.withColumn("turn", F.col("cap") / F.col("w"))
    lo, hi = s.agg(F.min("turn"), F.max("turn")).first()
    if lo is None:
        return 0.0
    capped = 0.0
    while True:
        width = (hi - lo) / bins
        place = F.least(F.floor((F.col("turn") - lo) / width), F.lit(bins - 1)) if width > 0 else F.lit(0)
        rows = sorted(tuple(r) for r in s.filter(F.col("turn").between(lo, hi)).groupBy(place.alias("bin")).agg(
            F.sum("cap"), F.sum("w"), F.min("turn"), F.max("turn")).collect())
        for _, cap, w, first, last in rows:
            if capped + cap + last * (free - w) >= want:
                break  # reached by the bin's last turn
            capped, free = capped + cap, free - w
        else:
            return hi  # every source is capped
        if first == last or capped + first * free >= want:
            return (want - capped) / free
        lo, hi = first, last


def source_targets(sized: DataFrame, weights=WEIGHTS, max_repeat: int = MAX_REPEAT,
                   total: float | None = None) -> DataFrame:
    """(source, sid, source_size, target) from rows (source, size)."""
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    s = _ordered_sources(per)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (F.col("sid") % len(weights) + 1).cast("int"))
    s = staged(s.withColumn("w", weight).withColumn("cap", F.col("source_size") * float(max_repeat)), "targets")
    all_words, all_w = s.agg(F.sum("source_size"), F.sum("w")).first()
    want = float(all_words or 0) if total is None else float(total)
    level = _water_level(s.select("w", "cap"), want, float(all_w or 0))
    return s.select("source", "sid", "source_size",
                    F.least("cap", F.col("w") * F.lit(level)).alias("target"))


def _boundary(rows: DataFrame, need: DataFrame, part: str) -> DataFrame:
    """(sid, part, part_before, need): the part of each source in which its need runs out.

    ``rows`` (sid, part, size); ``need`` (sid, need > 0).  Parts are few per source.
    """
    per = rows.groupBy("sid", part).agg(F.sum("size").alias("words"))
    w = Window.partitionBy("sid").orderBy(part)
    run = per.withColumn("upto", F.sum("words").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    run = run.withColumn("before", F.col("upto") - F.col("words"))
    return (run.join(need, "sid").filter((F.col("upto") > F.col("need")) & (F.col("before") <= F.col("need")))
               .select("sid", F.col(part).alias(f"{part}_cut"), (F.col("need") - F.col("before")).alias("need")))


def draw(base: DataFrame, targets: DataFrame, whole_documents: bool = False, blocks: int = BLOCKS) -> DataFrame:
    """``base`` (key, source, size; staged) with sid, source_size, target, block,
    epochs (whole takes) and ``extra`` (words of the partial take).

    Without ``whole_documents`` the document in which a source's target runs
    out gives only the words still needed, so the taken words equal the
    rounded target; with it that document is taken when at least half fits.
    """
    t = targets.withColumnRenamed("source", "_src")
    h = F.col("key")
    rows = (base.join(t, F.col("source").eqNullSafe(F.col("_src")), "left").drop("_src")
                .withColumn("block", F.pmod(h, F.lit(blocks)))
                .withColumn("sub", F.pmod(F.shiftrightunsigned(h, 16), F.lit(blocks))))
    whole = F.when(F.col("source_size") > 0, F.floor(F.round("target") / F.col("source_size"))).otherwise(0).cast("long")
    rows = rows.withColumn("epochs", whole)
    need = (targets.withColumn("epochs", whole)
                   .select("sid", (F.round("target").cast("long") - F.col("epochs") * F.col("source_size")).alias("need")))
    cut1 = staged(_boundary(rows.select("sid", "block", "size"), need, "block"), "cut")
    in1 = rows.join(cut1.select("sid", "block_cut"), "sid").filter("block = block_cut")
    cut2 = staged(_boundary(in1.select("sid", "sub", "size"), cut1.select("sid", "need"), "sub"), "cut")
    cuts = (cut1.select("sid", "block_cut").join(cut2.select("sid", "sub_cut", "need"), "sid"))
    rows = rows.join(cuts, "sid", "left")
    # documents of the one sub-block in which the target runs out, in key order
    last = rows.filter("block = block_cut and sub = sub_cut")
    w = Window.partitionBy("sid").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    last = last.withColumn("part", F.greatest(F.lit(0), F.least("size", F.col("need") - F.coalesce(F.sum("size").over(w), F.lit(0)))))
    if whole_documents:
        last = last.withColumn("part", F.when(F.col("part") * 2 >= F.col("size"), F.col("size")).otherwise(F.lit(0)))
    early = F.col("block_cut").isNotNull() & ((F.col("block") < F.col("block_cut"))
                                              | ((F.col("block") == F.col("block_cut")) & (F.col("sub") < F.col("sub_cut"))))
    rest = rows.filter(~F.coalesce((F.col("block") == F.col("block_cut")) & (F.col("sub") == F.col("sub_cut")), F.lit(False)))
    rest = rest.withColumn("part", F.when(early, F.col("size")).otherwise(F.lit(0)))
    return (rest.unionByName(last).withColumnRenamed("part", "extra")
                .drop("sub", "sub_cut", "block_cut", "need"))


def split_quotas(quotas: np.ndarray, shards: int, rng: np.random.Generator,
                 room: np.ndarray | None = None) -> np.ndarray:
    """(sources x shards) counts whose rows sum to ``quotas``: a binary tree of
    multivariate-hypergeometric draws.  ``room`` gives the shards' exact totals
    (default: as equal as possible)."""
    quotas = np.asarray(quotas, np.int64)
    total = int(quotas.sum())
    if room is None:
        room = np.full(shards, total // shards, np.int64)
        room[:total % shards] += 1
    out = np.zeros((len(quotas), shards), np.int64)

    def node(q, lo, hi):
        if hi - lo == 1:
            out[:, lo] = q
            return
        mid = (lo + hi) // 2
        left = rng.multivariate_hypergeometric(q, int(room[lo:mid].sum()), method="marginals")
        node(left, lo, mid)
        node(q - left, mid, hi)

    node(quotas, 0, shards)
    return out


def shard_bounds(quota: DataFrame, shards: int, seed: int = SEED, strata: int = STRATA) -> DataFrame:
    """(sid, bounds): for each source the running sum of its shard quotas.

    ``quota`` (sid, quota).  The driver splits at most ``strata`` sums; the
    sources of a stratum are split by a job, each stratum seeded by its number.
    """
    prepare(quota.sparkSession)
    s = quota.withColumn("stratum", F.pmod("sid", F.lit(strata)).cast("int"))
    sums = sorted(tuple(r) for r in s.groupBy("stratum").agg(F.sum("quota")).collect())  # <= strata rows
    table = split_quotas(np.array([q for _, q in sums], np.int64), shards, np.random.default_rng(seed)) if sums else []
    rooms = {st: [int(x) for x in table[i]] for i, (st, _) in enumerate(sums)}

    def inner(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("sid")
        st = int(pdf["stratum"].iloc[0])
        parts = split_quotas(pdf["quota"].to_numpy(), shards, np.random.default_rng([seed, st]),
                             np.array(rooms[st], np.int64))
        return pd.DataFrame({"sid": pdf["sid"].to_numpy(), "bounds": [x.tolist() for x in parts.cumsum(axis=1)]})

    return s.groupBy("stratum").applyInPandas(inner, "sid long, bounds array<long>")


def _base(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "source", word_count(F.col("text")).alias("size"),
                       F.xxhash64(F.lit(SEED), "doc_id", "text").alias("key"))


def mixed_quantities(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken, the shards of its block's takes and the first of them."""
    base = staged(_base(docs), "mix")
    targets = staged(source_targets(base), "targets")
    drawn = staged(draw(base, targets).withColumn("taken", F.col("epochs") * F.col("size") + F.col("extra")), "drawn")
    return _with_shards(drawn, 8).select("doc_id", "size", "source_size", "target", "taken", F.get("shards", F.lit(0)).alias("shard"),
                                         "shards")


def takes(drawn: DataFrame) -> DataFrame:
    """(sid, block, rank, epochs, partial, blocks): the blocks with taken words of every
    source, their place among its ``blocks`` ones, and how they are taken."""
    per = (drawn.groupBy("sid", "block").agg(F.max(F.when(F.col("taken") > 0, F.col("epochs"))).alias("epochs"),
                                             F.max(F.col("extra") > 0).alias("partial")).filter("epochs IS NOT NULL"))
    w = Window.partitionBy("sid")  # at most BLOCKS rows a source
    return per.select("sid", "block", "epochs", "partial", (F.row_number().over(w.orderBy("block")) - 1).alias("rank"),
                      F.count(F.lit(1)).over(w).alias("blocks"))


def _with_shards(drawn: DataFrame, shards: int) -> DataFrame:
    """Add ``shards``: the shard that the quota tree gives to each take of the row's
    block, whole epochs first (null for blocks that are not drawn at all)."""
    t = staged(takes(drawn), "blocks")
    quota = t.groupBy("sid").agg(F.sum(F.col("epochs") + F.col("partial").cast("long")).alias("quota"))
    # place of a take among its source's: epoch by epoch, the partial one last
    places = F.transform(F.sequence(F.lit(0), F.col("epochs") + F.col("partial").cast("long") - 1),
                         lambda e: e * F.col("blocks") + F.col("rank"))
    where = t.join(shard_bounds(quota, shards), "sid").select(
        "sid", "block", F.transform(places, lambda p: F.size(F.filter("bounds", lambda b: b <= p))).alias("shards"))
    return drawn.join(where, ["sid", "block"], "left")


def mixed_documents(docs: DataFrame, shards: int = 8) -> DataFrame:
    """``docs`` with each row repeated as often as the mix takes it (whole
    documents), dealt to the shards' partitions and shuffled inside them.

    Rows are matched to their draw by the keyed hash of (id, text); equal rows
    share it and are counted apart by size of the draw table (one row per key).
    """
    rows = docs.withColumn("_tm_key", F.xxhash64(F.lit(SEED), "doc_id", "text"))
    base = staged(_base(docs), "mix")
    targets = staged(source_targets(base), "targets")
    drawn = draw(base, targets, whole_documents=True).withColumn(
        "taken", F.col("epochs") * F.col("size") + F.col("extra"))
    drawn = staged(drawn.withColumn("times", F.col("epochs") + (F.col("extra") > 0).cast("long")), "drawn")
    # equal rows: the first ones by number take the extra copy; sum the copies per key
    per = (_with_shards(drawn, shards).groupBy("key", "source")
           .agg(F.sum("times").alias("_tm_times"), F.count(F.lit(1)).alias("_tm_rows"), F.max("shards").alias("_tm_shards")))
    per = per.select(F.col("key").alias("_tm_k"), F.col("source").alias("_tm_src"), "_tm_times", "_tm_rows",
                     "_tm_shards").filter("_tm_times > 0")
    hit = rows.join(per, (F.col("_tm_key") == F.col("_tm_k")) & F.col("source").eqNullSafe(F.col("_tm_src")))
    # of r equal rows that are taken t times in all, each is taken t div r times and t mod r once more
    w = Window.partitionBy("_tm_key", "source").orderBy(F.lit(0))
    many = hit.filter("_tm_rows > 1").withColumn("_tm_i", F.row_number().over(w))
    one = hit.filter("_tm_rows = 1").withColumn("_tm_i", F.lit(1))
    both = one.unionByName(many)
    times = (F.floor(F.col("_tm_times") / F.col("_tm_rows"))
             + (F.col("_tm_i") <= F.col("_tm_times") % F.col("_tm_rows")).cast("long")).cast("int")
    copies = both.withColumn("_tm_copy", F.explode(F.when(times > 0, F.sequence(F.lit(1), times)).otherwise(F.array().cast("array<int>"))))
    order = F.xxhash64(F.lit(SEED), "_tm_key", "_tm_copy", "_tm_i")
    n = shuffle_width(docs.sparkSession)
    copies = copies.withColumn("_tm_shard", F.element_at("_tm_shards", F.least("_tm_copy", F.size("_tm_shards"))))
    return (copies.withColumn("_tm_o", order)
                  .repartition(n, "_tm_shard", F.pmod("_tm_o", F.lit(max(1, n // shards))))
                  .sortWithinPartitions("_tm_shard", "_tm_o").select(*docs.columns))


def op7_mixing(spark, sf_dir):
    return mixed_quantities(documents(spark, sf_dir).select("doc_id", "source", "text"))
