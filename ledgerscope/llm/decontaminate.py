"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Every window of 13 consecutive benchmark words is a pattern (an item of fewer
words is one pattern). Patterns of one length share a scanner: a block of two
words at the window's end looks up how far the window may shift without missing
an occurrence; shift 0 selects the bucket of patterns that end in this block,
the first word narrows it, and direct comparison confirms.

Benchmarks are searched in blocks of at most ``block_words`` words (one item may
exceed it), each collected and shipped to the scan as one closure; documents are
never shuffled. Defined cases: null or empty texts have no words and hit
nothing; a null item_id counts as the empty string; repeated items and item_ids
count once; documents keep all their rows and columns.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerscope.llm.common import utf8

WINDOW = 13
BLOCK_WORDS = 2_000_000
MIN_SHARE = 20  # contaminated: MIN_SHARE * n_hit >= n_words
RESULT = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
                       T.StructField("spans", T.ArrayType(T.LongType())),
                       T.StructField("items", T.ArrayType(T.StringType()))])
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")  # of lower-cased UTF-8: ASCII alphanumerics and everything beyond ASCII


def words_of(text) -> list[bytes]:
    return _WORD.findall(utf8(text).lower())


class WuManber:
    """Scanner for patterns of one length m (tuples of words)."""

    def __init__(self, patterns: dict[tuple, set]):
        self.m = m = len(next(iter(patterns)))
        self.block = b = min(2, m)
        self.default = m - b + 1
        self.shift: dict = {}
        self.buckets: dict = {}
        for p, items in patterns.items():
            for end in range(b, m + 1):
                key = p[end - b:end]
                self.shift[key] = min(self.shift.get(key, self.default), m - end)
            self.buckets.setdefault(p[m - b:], {}).setdefault(p[0], []).append((p, items))

    def scan(self, words: list[bytes]):
        """(first word, items) of each occurrence, in order."""
        m, b, default, shift, buckets = self.m, self.block, self.default, self.shift, self.buckets
        i, n = m, len(words)
        get = shift.get
        while i <= n:
            key = (words[i - 2], words[i - 1]) if b == 2 else (words[i - 1],)
            s = get(key, default)
            if s:
                i += s
                continue
            start = i - m
            for p, items in buckets[key].get(words[start], ()):
                if tuple(words[start:i]) == p:
                    yield start, items
            i += 1


def scanners(items: list[tuple[str, str]], window: int = WINDOW) -> list[WuManber]:
    by_len: dict[int, dict] = {}
    for item_id, text in items:
        w = tuple(words_of(text))
        size = min(window, len(w))
        for i in range(len(w) - size + 1 if size else 0):
            by_len.setdefault(size, {}).setdefault(w[i:i + size], set()).add(item_id)
    return [WuManber(p) for _, p in sorted(by_len.items())]


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def _search(block: list[tuple[str, str]], window: int):
    """A UDF over (text, what earlier blocks have found)."""
    state: dict = {}

    @F.pandas_udf(RESULT)
    def search(texts: pd.Series, earlier: pd.DataFrame) -> pd.DataFrame:
        if "scan" not in state:
            state["scan"] = scanners(block, window)
        rows = []
        for text, before, found in zip(texts, earlier["spans"], earlier["items"]):
            words = words_of(text)
            got = list(zip(before[::2], before[1::2]))
            ids = set(found)
            for wm in state["scan"]:
                for start, of in wm.scan(words):
                    got.append((start, start + wm.m))
                    ids |= of
            got = _merge(got)
            rows.append((len(words), sum(e - s for s, e in got), [int(x) for se in got for x in se], sorted(ids)))
        return pd.DataFrame(rows, columns=RESULT.names)
    return search


def with_hits(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", out: str = "hits",
              window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` plus a struct ``out``: n_words, n_hit, spans (word offsets: start,
    end, start, end, ...; merged) and items (sorted item_ids with an occurrence)."""
    bench = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text") \
        .filter("text is not null").distinct()
    total = bench.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-total // (2 * block_words)))  # a word and its separator take two characters at least
    res = docs.withColumn(out, F.struct(F.lit(0).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_hit"),
                                        F.array().cast("array<long>").alias("spans"),
                                        F.array().cast("array<string>").alias("items")))
    for i in range(blocks):
        part = bench if blocks == 1 else bench.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == i)
        found = _search([(r.item_id, r.text) for r in part.collect()], window)
        res = res.withColumn(out, found(F.col(text_col), F.col(out)))
    return res


def is_contaminated(hits):
    return (hits["n_hit"] > 0) & (F.lit(MIN_SHARE) * hits["n_hit"] >= hits["n_words"])


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the contaminated ones; no shuffle, all columns kept."""
    return with_hits(docs, benchmark, out="__hits").filter(~is_contaminated(F.col("__hits"))).drop("__hits")
