"""Line dedup: explode normalised lines, hash, count distinct documents per hash,
drop lines over the threshold, reassemble by position.

A line's key is the line without the white space ``[\\x20\\x09-\\x0D]`` at both
ends and with A-Z lower-cased. Keys of at least ``min_chars`` code points that
at least ``min_documents`` distinct documents hold lose all their lines, except
those in the smallest doc_id that holds the key. Keys travel as two 64-bit
hashes (128 bits together), never as text.

Hot lines: distinct (key, document) pairs are made before keys are counted, so a
line that a third of all documents hold is counted from partial counts. For the
join back, the keys that hold at least 1/``HEAVY_SHARE`` of all rows are
broadcast: there are at most ``HEAVY_SHARE`` of them whatever the table. All
other keys meet their rows in a shuffle join in which none of them is hot.
Texts are shuffled once, to meet their dropped positions. Built-in functions only.

Defined cases: null and empty texts are one empty line; rows with one doc_id are
one document (so a row repeated as it is stays whole, in every copy); a null
doc_id is one document and comes after all others; a document that loses all its
lines keeps an empty text; an empty table gives an empty table; extra columns
are ignored by ``deduplicated_lines`` and kept by ``drop_repeated_lines``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerscope.llm.common import stage

MIN_CHARS = 10
MIN_DOCUMENTS = 2
HEAVY_SHARE = 20000
_SPACE = "\t\n\x0b\x0c\r "
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    """The normalised line. On ASCII lines ``lower`` is the A-Z mapping, and faster."""
    bare = F.trim(line, F.lit(_SPACE))
    return F.when(F.octet_length(bare) == F.char_length(bare), F.lower(bare)).otherwise(F.translate(bare, _UPPER, _LOWER))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _identified(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``docs`` plus __id, __none (no id) and __th: equal values mean equal rows for this operator."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.withColumns({"__id": F.coalesce(F.col(id_col).cast("string"), F.lit("")), "__none": F.col(id_col).isNull(),
                             "__th": F.xxhash64(text), "__th2": F.xxhash64(F.lit(1), text)})


_ROW = ["__id", "__none", "__th", "__th2"]


def repeated_positions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
                       min_documents: int = MIN_DOCUMENTS, heavy_share: int = HEAVY_SHARE) -> DataFrame:
    """(__id, __none, __th, __th2, gone): per document that loses lines, their sorted positions from 0."""
    lines = _identified(docs, id_col, text_col).select(
        F.col(id_col).alias("doc"), *_ROW, F.posexplode(_lines(F.col(text_col))).alias("pos", "line"))
    keys = lines.withColumn("key", line_key(F.col("line"))).filter(F.char_length("key") >= min_chars)
    held = stage(keys.select("doc", *_ROW, "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2")),
                 "lines")
    per_document = held.groupBy("h1", "h2", "doc").agg(F.count("*").alias("rows"))
    # min() skips nulls: a key has no first document only where the null document alone holds it.
    counts = per_document.groupBy("h1", "h2").agg(F.count("*").alias("documents"), F.sum("rows").alias("rows"),
                                                  F.min("doc").alias("first"))
    over = stage(counts.filter(F.col("documents") >= min_documents), "repeated-keys")
    least = held.count() / heavy_share
    heavy = over.filter(F.col("rows") >= least).select("h1", "h2", "first", F.lit(True).alias("heavy"))  # <= heavy_share rows
    light = over.filter(F.col("rows") < least).select("h1", "h2", "first")
    marked = held.join(F.broadcast(heavy), ["h1", "h2"], "left")
    gone = ~F.col("doc").eqNullSafe(F.col("first"))
    hits = marked.filter("heavy").filter(gone).select(*_ROW, "pos").unionByName(
        marked.filter("heavy is null").drop("heavy", "first").join(light, ["h1", "h2"]).filter(gone).select(*_ROW, "pos"))
    return hits.groupBy(*_ROW).agg(F.array_sort(F.collect_set("pos")).alias("gone"))


def _kept(lines: Column, gone: Column) -> Column:
    """The lines whose positions are not in the sorted array ``gone``, in order: the
    stretches between neighbouring dropped positions, each cut out once."""
    n = F.size(gone)

    def stretch(i):
        start = F.when(i == 0, F.lit(0)).otherwise(F.element_at(gone, F.greatest(i, F.lit(1))) + 1)
        end = F.when(i == n, F.size(lines)).otherwise(F.element_at(gone, F.least(i + 1, n)))
        return F.slice(lines, start + 1, end - start)
    return F.flatten(F.transform(F.sequence(F.lit(0), n), stretch))


def _joined(docs: DataFrame, id_col: str, text_col: str, **kw) -> DataFrame:
    # Written first: a table's side of a skewed join can be split, an aggregate's cannot.
    gone = stage(repeated_positions(docs, id_col, text_col, **kw), "dropped-lines")
    marked = _identified(docs, id_col, text_col).join(gone.withColumnRenamed("gone", "__gone"), _ROW, "left")
    whole = F.coalesce(F.col(text_col), F.lit(""))
    rest = F.array_join(_kept(_lines(F.col(text_col)), F.col("__gone")), "\n")
    return marked.withColumn("__kept", F.when(F.col("__gone").isNull(), whole).otherwise(rest))


def deduplicated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """One row per row of ``docs``: its id, n_lines, n_dropped and the kept text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return _joined(docs, id_col, text_col, **kw).select(
        id_col, (F.char_length(text) - F.char_length(F.replace(text, F.lit("\n"))) + 1).cast("long").alias("n_lines"),
        F.when(F.col("__gone").isNull(), F.lit(0)).otherwise(F.size("__gone")).cast("long").alias("n_dropped"), F.col("__kept").alias("kept"))


def drop_repeated_lines(docs: DataFrame, **kw) -> DataFrame:
    """``docs`` with the kept text; n_chars follows where a line went. All rows and columns stay."""
    marked, text = _joined(docs, "doc_id", "text", **kw), F.col("text")
    lost = F.col("__gone").isNotNull()
    new = {"text": F.when(lost, F.col("__kept")).otherwise(text)}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(lost, F.char_length("__kept").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return marked.select(*[new[c].alias(c) if c in new else F.col(c) for c in docs.columns])
