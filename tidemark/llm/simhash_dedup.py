"""Operator 2 - SimHash near-duplicates through a segment-popcount embedding.

A 64-bit fingerprint is cut into 32 two-bit segments and mapped to the point
of its per-segment bit counts (0, 1 or 2 each).  Two fingerprints that differ
in d bits lie at Manhattan distance at most d, so the distance of the points
is a lower bound of the bit distance.  Written in unary (00, 01, 11) the point
fits a long and the Manhattan distance is the popcount of an XOR.

The range join (Manhattan <= 4) runs on a grid of unit cells in subspaces: the
segments form ``blocks`` groups; at distance <= 4 at least ``blocks`` - 4
groups agree exactly, so the pair shares a cell in one of the
C(blocks, blocks - 4) subspaces.  Inside a cell all pairs are compared by the
bound and the survivors by their bits.  More blocks mean finer cells and more
copies of each fingerprint (6: 15 copies of about 16 bits, 8: 70 of about 24);
``blocks_for`` chooses by the number of fingerprints.

Only distinct fingerprints are joined; a cell with more than ``tile`` of them
is cut into pairs of tiles, so no task holds a hot cell; a cell returns a
spanning forest of its links, not its pairs.  Components come from staged
star rounds, and documents get the component of their fingerprint.

Defined results: a text without words (null, empty, white space) has
fingerprint zero and links like any other; fewer than ``shingle`` words make
one shingle; repeated rows share their fingerprint; the component id is the
smallest non-null doc_id (null if all are null); an empty table gives an empty
result; other columns are never read, and ``one_per_group`` keeps them.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, documents, prepare, shuffle_width, staged

SHINGLE = 4
MAX_BITS = 4
BLOCKS = 6
SEED = 42
TILE = 4096
#: Shingle hashes counted at a time (bounds the memory of a long text).
STEP = 1 << 14


def simhash(text: str | None, shingle: int = SHINGLE) -> int:
    """Signed 64-bit fingerprint of a text (words and shingles of the contract)."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes.lower: A-Z only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    if len(words) <= shingle:
        starts, stops = [0], [len(joined)]
    else:
        starts = np.concatenate(([0], ends[:-shingle] + 1)).tolist()
        stops = ends[shingle - 1:].tolist()
    n, ones, digest = len(starts), np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for at in range(0, n, STEP):
        h = np.array([digest(joined[a:b], SEED) for a, b in zip(starts[at:at + STEP], stops[at:at + STEP])], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (ones * 2 > n).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def fingerprint_udf(shingle: int = SHINGLE):
    @F.pandas_udf("long")
    def fp(texts: pd.Series) -> pd.Series:
        return pd.Series([simhash(t, shingle) for t in texts], dtype="int64")

    return fp


def _masks(blocks: int) -> list[int]:
    """Bit masks of ``blocks`` groups of two-bit segments."""
    cut = [round(32 * i / blocks) * 2 for i in range(blocks + 1)]
    return [((1 << (b - a)) - 1) << a for a, b in zip(cut, cut[1:])]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def unary_counts(fp):
    """The embedding: per two-bit segment its bit count in unary (native)."""
    low = F.lit(0x5555555555555555)
    hi = F.shiftrightunsigned(fp, 1)
    return (F.shiftleft(fp.bitwiseAND(hi).bitwiseAND(low), 1)
            .bitwiseOR(fp.bitwiseOR(hi).bitwiseAND(low)))


class _Forest:
    """Spanning forest of links inside one run of rows."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray):
        lab = self.label
        while True:
            x, y = lab[a], lab[b]
            if (x == y).all():
                return
            lo, hi = np.minimum(x, y), np.maximum(x, y)
            np.minimum.at(lab, hi, lo)
            while True:  # every label its own root again
                nxt = lab[lab]
                if (nxt == lab).all():
                    break
                lab[:] = nxt


def cell_links(cell: np.ndarray, fp: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Forest edges between rows of equal ``cell`` (sorted) within ``max_bits``.

    Row i is compared with row i+d of its cell for d = 1, 2, ...: first by the
    Manhattan bound on the unary counts, then exactly.
    """
    low = np.uint64(0x5555555555555555)
    one = np.uint64(1)
    u = fp.view(np.uint64)
    hi = u >> one
    point = ((u & hi & low) << one) | ((u | hi) & low)
    forest = _Forest(len(fp))
    at, d, pend, held = np.arange(len(fp)), 0, [], 0
    while True:
        d += 1
        at = at[at + d < len(fp)]
        at = at[cell[at] == cell[at + d]]
        if not len(at):
            break
        near = at[np.bitwise_count(point[at] ^ point[at + d]) <= max_bits]
        near = near[np.bitwise_count(u[near] ^ u[near + d]) <= max_bits]
        if len(near):
            pend.append((near, near + d))
            held += len(near)
        if held > 1 << 16:
            forest.link(*map(np.concatenate, zip(*pend)))
            pend, held = [], 0
    if pend:
        forest.link(*map(np.concatenate, zip(*pend)))
    linked = np.flatnonzero(forest.label != np.arange(len(fp)))
    return fp[linked], fp[forest.label[linked]]


def _links_in_partition(max_bits: int):
    """mapInArrow body over rows (cell, fp) sorted by cell; a cell may span batches."""
    def run(batches):
        rest_c, rest_f = np.empty(0, np.int64), np.empty(0, np.int64)

        def flush(c, f):
            a, b = cell_links(c, f, max_bits)
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["src", "dst"])

        for batch in batches:
            c = np.concatenate((rest_c, batch.column(0).to_numpy(zero_copy_only=False)))
            f = np.concatenate((rest_f, batch.column(1).to_numpy(zero_copy_only=False)))
            if not len(c):
                continue
            cut = int(np.searchsorted(c, c[-1]))  # the last cell may go on
            rest_c, rest_f = c[cut:], f[cut:]
            if cut:
                yield flush(c[:cut], f[:cut])
        if len(rest_c):
            yield flush(rest_c, rest_f)

    return run


def fingerprint_links(nodes: DataFrame, max_bits: int = MAX_BITS, blocks: int = BLOCKS,
                      tile: int = TILE) -> DataFrame:
    """Links (src, dst) that span every set of distinct fingerprints ``fp``
    connected by at most ``max_bits`` differing bits."""
    spark = prepare(nodes.sparkSession)
    if blocks <= max_bits:
        raise ValueError("blocks must exceed max_bits")
    masks = _masks(blocks)
    combos = [sum(masks[i] for i in c) for c in combinations(range(blocks), blocks - max_bits)]
    point = unary_counts(F.col("fp"))
    cells = nodes.select("fp", point.alias("p")).select("fp", F.explode(F.array(*[
        F.xxhash64(F.lit(i), F.col("p").bitwiseAND(F.lit(_signed(m)))) for i, m in enumerate(combos)])).alias("cell"))
    crowded = (cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > tile)
                    .select("cell", F.ceil(F.col("n") / tile).cast("int").alias("tiles")))
    mine = F.pmod(F.xxhash64("fp", F.lit(7)), F.col("tiles")).cast("int")
    # a row of a crowded cell goes to the pairs (its tile, every tile)
    tiled = (cells.join(crowded, "cell", "left")
                  .withColumn("other", F.explode(F.when(F.col("tiles").isNull(), F.array(F.lit(-1)))
                                                  .otherwise(F.sequence(F.lit(0), F.col("tiles") - 1))))
                  .select(F.when(F.col("tiles").isNull(), F.col("cell"))
                           .otherwise(F.xxhash64("cell", F.least(mine, "other"), F.greatest(mine, "other")))
                           .alias("cell"), "fp"))
    dealt = tiled.repartition(shuffle_width(spark), "cell").sortWithinPartitions("cell")
    return dealt.mapInArrow(_links_in_partition(max_bits), "src long, dst long")


def blocks_for(nodes: int) -> int:
    """Groups of segments for so many fingerprints: finer cells for more of them."""
    return BLOCKS + (nodes > 1 << 22) + (nodes > 1 << 30)


def labelled(fps: DataFrame, max_bits: int = MAX_BITS, blocks: int | None = None) -> DataFrame:
    """``fps`` (doc_id, fp, ...; staged) with component_id and ``label``, the smallest
    fingerprint of the component (never null)."""
    nodes = staged(fps.groupBy("fp").agg(F.min("doc_id").alias("low")), "nodes")
    links = fingerprint_links(nodes, max_bits, blocks or blocks_for(nodes.count()))
    labels = components(staged(links, "links"))
    merged = (nodes.join(labels.select(F.col("node").alias("fp"), "label"), "fp", "left")
                   .select("fp", "low", F.coalesce("label", "fp").alias("label")))
    heads = merged.groupBy("label").agg(F.min("low").alias("component_id"))
    comp = staged(merged.join(heads, "label").select("fp", "component_id", "label"), "components")
    # only a group of copies can be hot here, on the left: a skew join splits it
    return fps.join(comp, "fp", "left")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS,
                    blocks: int | None = None) -> DataFrame:
    """(doc_id, fp, component_id, label) for every row of ``docs``; ``label`` is the
    smallest fingerprint of the component and never null."""
    prepare(docs.sparkSession)
    fps = staged(docs.select("doc_id", fingerprint_udf(shingle)("text").alias("fp")), "fingerprints")
    return labelled(fps, max_bits, blocks).select("doc_id", "fp", "component_id", "label")


def one_per_group(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS,
                  blocks: int | None = None) -> DataFrame:
    """``docs`` with one row of every component, one with the smallest doc_id
    (of repeated rows, and of rows that share the id, one stays).

    The rows are staged once with their fingerprint and a row number; what goes is a
    table of row numbers, so that no text is shuffled while that table is small.
    """
    prepare(docs.sparkSession)
    rows = staged(docs.withColumns({"_tm_fp": fingerprint_udf(shingle)("text"), "_tm_hash": F.xxhash64("text"),
                                    "_tm_row": F.monotonically_increasing_id()}), "fingerprinted")
    slim = rows.select("doc_id", F.col("_tm_fp").alias("fp"), "_tm_hash", "_tm_row")
    ids = labelled(slim, max_bits, blocks)
    first = F.struct(F.col("doc_id").isNull(), "doc_id", "fp", "_tm_hash", "_tm_row")
    heads = ids.groupBy("label").agg(F.min(first).alias("_tm_first")).select("_tm_first._tm_row")
    gone = staged(slim.select("_tm_row").join(heads, "_tm_row", "left_anti"), "removed-rows")
    return rows.join(gone, "_tm_row", "left_anti").select(*docs.columns)


def op2_simhash(spark, sf_dir):
    d = near_duplicates(documents(spark, sf_dir).select("doc_id", "text"))
    return d.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
