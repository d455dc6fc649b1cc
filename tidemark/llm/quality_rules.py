"""Operator 1 - quality rules judged per document and per host.

Every document gets the base statistics of its whole text.  Rule failures are
counted per host (``source``); a host's failure rate is shrunk towards the
corpus by an empirical beta prior (method of moments over all hosts), so a
host with few documents is not condemned by one bad page.  A host whose
shrunk rate is above ``max_host_rate`` is rejected and the verdict is joined
back to its documents.

Defined results: a null or empty text has no words and fails; a null host is a
host of its own; repeated rows count as often as they occur; an empty table
gives an empty result; columns other than (doc_id, text, source) pass through
``rejected_rows_removed`` untouched and never reach the statistics.
"""

from __future__ import annotations

import re
from collections import Counter

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, prepare, staged

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
REPEAT_WINDOW = 5
#: Above this shrunk share of failing documents a host is rejected.
MAX_HOST_RATE = 0.5

_SYMBOLS = b"#*$%&|<>"
_SPACES = b" \t\n\x0b\x0c\r"
_NOT_LEADING = bytes(range(0x80, 0xC0))  # UTF-8 continuation bytes
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
STATS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def repeat_words(words: list[bytes], k: int = REPEAT_WINDOW) -> int:
    """Words covered by a k-word window that occurs at least twice in the text."""
    n = len(words) - k + 1
    if n < 2:
        return 0
    windows = list(zip(*[words[i:] for i in range(k)]))
    if len(set(windows)) == n:
        return 0
    seen = Counter(windows)
    covered, end = 0, 0
    for i, w in enumerate(windows):
        if seen[w] > 1:
            covered += i + k - max(end, i)
            end = i + k
    return covered


def text_stats(text: str | None) -> tuple[int, int, int, int, int]:
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    chars = len(raw.translate(None, _SPACES + _NOT_LEADING))
    symbols = len(raw) - len(raw.translate(None, _SYMBOLS))
    dup = 0
    if b"\n" in raw:
        lines = [x for x in raw.split(b"\n") if _WORD.search(x)]
        dup = len(lines) - len(set(lines))
    return len(words), chars, symbols, dup, repeat_words(words)


def stats_udf():
    @F.pandas_udf(STATS)
    def stats(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([text_stats(t) for t in texts],
                            columns=["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"])

    return stats


def base_failed(n_words, n_repeat_words):
    return (n_words < MIN_WORDS) | (n_repeat_words * 100 > n_words * MAX_REPEAT_PERCENT)


def host_verdicts(judged: DataFrame, host: str = "source", failed: str = "base_failed",
                  max_host_rate: float = MAX_HOST_RATE) -> DataFrame:
    """(host, n_docs, n_failed, shrunk_rate, host_ok), one row per host.

    The prior Beta(m k, (1 - m) k) has the mean m and variance v of the host
    rates: k = m (1 - m) / v - 1.  With no spread between hosts (or one host)
    k is set to the mean host size, i.e. the host and the corpus weigh alike.
    """
    hosts = judged.groupBy(host).agg(F.count(F.lit(1)).alias("n_docs"),
                                     F.sum(F.col(failed).cast("long")).alias("n_failed"))
    rate = F.col("n_failed") / F.col("n_docs")
    m, v, size = hosts.agg(F.avg(rate), F.var_pop(rate), F.avg("n_docs")).first()
    m, v, size = m or 0.0, v or 0.0, size or 1.0
    k = max(m * (1 - m) / v - 1, 1.0) if v > 1e-12 and 0 < m < 1 else size
    shrunk = (F.col("n_failed") + F.lit(m * k)) / (F.col("n_docs") + F.lit(k))
    return hosts.select(F.col(host), "n_docs", "n_failed", shrunk.alias("shrunk_rate"),
                        (shrunk <= F.lit(max_host_rate)).alias("host_ok"))


def quality_rules(docs: DataFrame, host: str = "source", max_host_rate: float = MAX_HOST_RATE) -> DataFrame:
    """One row per document: doc_id, the base statistics, base_failed, shrunk_rate, kept.

    The statistics are computed once and staged (no text in them); hosts are
    aggregated from that table and joined back null-safely.
    """
    prepare(docs.sparkSession)
    s = docs.select("doc_id", F.col(host).alias("_host"), stats_udf()("text").alias("_s"))
    judged = s.select("doc_id", "_host", "_s.*").withColumn(
        "base_failed", base_failed(F.col("n_words"), F.col("n_repeat_words")))
    judged = staged(judged, "quality")
    verdicts = host_verdicts(judged, "_host", max_host_rate=max_host_rate)
    v = verdicts.select(F.col("_host").alias("_h"), "shrunk_rate", "host_ok")
    return (judged.join(v, judged["_host"].eqNullSafe(v["_h"]), "left")
                  .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                          "base_failed", (~F.col("base_failed") & F.col("host_ok")).alias("kept"), "shrunk_rate"))


def rejected_rows_removed(docs: DataFrame, host: str = "source",
                          max_host_rate: float = MAX_HOST_RATE) -> DataFrame:
    """The rows of ``docs`` that pass, all columns kept.

    The texts are judged where they are (a column-wise UDF), so rows need no
    unique id; the second pass over the texts costs less than shuffling them.
    """
    prepare(docs.sparkSession)
    cols = docs.columns
    s = docs.withColumn("_tm_s", stats_udf()("text"))
    judged = s.withColumn("_tm_failed", base_failed(F.col("_tm_s.n_words"), F.col("_tm_s.n_repeat_words")))
    v = host_verdicts(judged.select(F.col(host).alias("_tm_h"), "_tm_failed"), "_tm_h", "_tm_failed",
                      max_host_rate).filter("host_ok").select("_tm_h")
    v = staged(v, "hosts")  # its size is known then, and a small one is broadcast instead of moving the texts
    return (judged.filter(~F.col("_tm_failed"))
                  .join(v, F.col(host).eqNullSafe(F.col("_tm_h")), "left_semi").select(*cols))


def op1_quality_rules(spark, sf_dir):
    return quality_rules(documents(spark, sf_dir)).drop("shrunk_rate")
