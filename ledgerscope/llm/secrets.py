"""Secret scan with corpus-wide ownership frequency.

Three patterns find base spans (assignments, access key ids, long hexadecimal
runs); a fourth finds credential-shaped tokens. All values are hashed and
counted by distinct owner (``source``) and by distinct document. A value that
several owners or many documents hold is a copied example; one that at most
``max_owners`` and at most ``max_documents`` hold looks live. Base spans always
stay and carry this verdict; credential-shaped tokens count only when live and
clear of base spans (kind ``live``).

Positions: splitting at a pattern and extracting its matches interleave, so
running lengths give every match's offset in code points. Built-in functions
only. The join with the frequencies is salted by document, so a value that a
third of all documents hold is spread over ``SALT`` tasks.

Defined cases: null and empty texts have no spans; the null source is one
owner; repeated rows get the same spans and count as one document; extra
columns are ignored by the scan and kept by ``redact``; null ids are allowed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerscope.llm.common import stage

# The kinds in the order of listing, their patterns, and the shortest value.
ASSIGN = (r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
          r"|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = r"AKIA[A-Z0-9]{14,}"  # a run of 18 or more characters; shorter runs hold no longer one
HEX = r"[0-9a-f]{16,}"
WIDE = r"[A-Za-z0-9+/_-]{20,}"
KINDS = ("assign", "access", "hex", "live")
MIN_ASSIGN = 12
MAX_OWNERS = 1
MAX_DOCUMENTS = 2
SALT = 16
_STEP = 128


def _offsets(lens: Column) -> Column:
    """Exclusive running sums of an array of longs, in blocks, so that appending
    never copies more than a block or the list of blocks."""
    blocks = F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.size(lens) - 1) / _STEP)).cast("int")),
                         lambda k: F.slice(lens, k * _STEP + 1, F.lit(_STEP)))

    def scan(values, first):
        return F.aggregate(values, F.struct(first.alias("at"), F.array().cast("array<long>").alias("out")),
                           lambda acc, x: F.struct((acc["at"] + x).alias("at"),
                                                   F.array_append(acc["out"], acc["at"]).alias("out")))["out"]
    zero = F.lit(0).cast("long")
    firsts = scan(F.transform(blocks, lambda b: F.aggregate(b, zero, lambda s, x: s + x)), zero)
    return F.flatten(F.transform(F.arrays_zip(blocks.alias("b"), firsts.alias("f")), lambda z: scan(z["b"], z["f"])))


def _spans(text: Column, kind: str, pattern: str, group: int = 0) -> Column:
    """array<struct<start, rank, end, value>> of all matches of a pattern."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    gaps = F.split(text, pattern, -1)
    # The start of match i: the gaps up to it and the matches before it.
    gap_len = F.transform(F.slice(gaps, F.lit(1), F.size(whole)), lambda g: F.length(g).cast("long"))
    len_ = F.transform(whole, lambda m: F.length(m).cast("long"))
    steps = F.transform(F.arrays_zip(gap_len.alias("g"), len_.alias("l"), value.alias("v")),
                        lambda z: F.struct(z["g"].alias("g"), z["l"].alias("l"), z["v"].alias("v")))
    ends = _offsets(F.transform(steps, lambda z: z["g"] + z["l"]))
    spans = F.transform(F.arrays_zip(steps.alias("s"), ends.alias("o")), lambda z: F.struct(
        (z["o"] + z["s"]["g"]).alias("start"), F.lit(KINDS.index(kind)).alias("rank"),
        (z["o"] + z["s"]["g"] + z["s"]["l"]).alias("end"), z["s"]["v"].alias("value")))
    return F.when(text.rlike(pattern), spans).otherwise(F.array().cast(
        "array<struct<start:bigint,rank:int,end:bigint,value:string>>"))


def _credential(value: Column) -> Column:
    return value.rlike("[0-9]") & value.rlike("[a-z]") & value.rlike("[A-Z]")


def _found(docs: DataFrame, id_col: str, text_col: str, owner_col: str) -> DataFrame:
    """Staged narrow rows: __id, __th, id, owner, found (base and wide spans with hashed values)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("__id"),
                       F.xxhash64(text).alias("__th"), F.col(id_col).alias("doc_id"),
                       F.coalesce(F.concat(F.lit("0"), F.col(owner_col).cast("string")), F.lit("1")).alias("owner"),
                       text.alias("t"))
    t = F.col("t")
    rows = rows.select("__id", "__th", "doc_id", "owner",
                       F.filter(_spans(t, "assign", ASSIGN, 2), lambda s: F.length(s["value"]) >= MIN_ASSIGN).alias("a"),
                       _spans(t, "access", ACCESS).alias("k"), _spans(t, "hex", HEX).alias("h"),
                       F.filter(_spans(t, "live", WIDE), lambda s: _credential(s["value"])).alias("w"))
    base = F.array_sort(F.concat("a", "k", "h"))
    rows = rows.withColumn("base", base).withColumn(
        "w", F.filter("w", lambda s: ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))))
    hashed = F.transform(F.concat("base", "w"), lambda s: F.struct(
        s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"),
        F.sha2(s["value"], 256).alias("hash")))
    return stage(rows.select("__id", "__th", "doc_id", "owner", hashed.alias("found")), "spans")


def _judged(found: DataFrame, max_owners: int, max_documents: int) -> DataFrame:
    """(__id, __th, spans) of the documents that keep any span: array<struct<start, rank, end, live>>."""
    some = found.filter(F.size("found") > 0)
    cand = some.select("__id", "__th", "owner", F.explode("found").alias("s"))
    held = cand.select(F.col("s.hash").alias("hash"), "owner", "__id", "__th")
    # Distinct pairs first, then partial counts: a value that many documents hold is no task of its own.
    owners = held.select("hash", "owner").distinct().groupBy("hash").agg(F.count("*").alias("owners"))
    documents = held.select("hash", "__id", "__th").distinct().groupBy("hash").agg(F.count("*").alias("documents"))
    freq = owners.join(documents, "hash").select(
        "hash", ((F.col("owners") <= max_owners) & (F.col("documents") <= max_documents)).alias("live"))
    salted = stage(freq.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1)))), "frequency")
    one = cand.select("__id", "__th", "s.start", "s.rank", "s.end", "s.hash",
                      F.pmod(F.xxhash64("__id", "__th"), F.lit(SALT)).cast("int").alias("salt"))
    return (one.join(salted, ["hash", "salt"]).filter((F.col("rank") < KINDS.index("live")) | F.col("live"))
            .groupBy("__id", "__th")
            .agg(F.array_sort(F.collect_set(F.struct("start", "rank", "end", "live"))).alias("spans")))


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
                 max_owners: int = MAX_OWNERS, max_documents: int = MAX_DOCUMENTS) -> DataFrame:
    """One row per row of ``docs``: doc_id and spans, sorted by start and kind."""
    found = _found(docs, id_col, text_col, owner_col)
    return (found.select("__id", "__th", "doc_id").join(_judged(found, max_owners, max_documents), ["__id", "__th"], "left")
            .select("doc_id", F.coalesce("spans", F.array().cast(
                "array<struct<start:bigint,rank:int,end:bigint,live:boolean>>")).alias("spans")))


def listed(spans: Column) -> Column:
    kind = lambda r: F.element_at(F.array(*[F.lit(k) for k in KINDS]), r + 1)
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", kind(s["rank"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, max_owners: int = MAX_OWNERS, max_documents: int = MAX_DOCUMENTS) -> DataFrame:
    """``docs`` with every span masked: live-looking ones as [SECRET], widely
    copied ones as [EXAMPLE_SECRET]; n_chars follows. All rows and columns stay."""
    judged = _judged(_found(docs, "doc_id", "text", "source"), max_owners, max_documents)
    text = F.coalesce(F.col("text"), F.lit(""))
    joined = docs.withColumns({"__id": F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
                               "__th": F.xxhash64(text)}).join(judged.withColumnRenamed("spans", "__spans"),
                                                               ["__id", "__th"], "left")

    def step(acc, s):
        mark = F.when(s["live"], F.lit("[SECRET]")).otherwise(F.lit("[EXAMPLE_SECRET]"))
        piece = F.substring(F.col("text"), (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"),
                        F.when(s["start"] >= acc["at"], F.concat(acc["out"], piece, mark)).otherwise(acc["out"]).alias("out"))
    done = F.aggregate("__spans", F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out")), step)
    masked = F.concat(done["out"], F.substring(F.col("text"), (done["at"] + 1).cast("int"), F.length("text")))
    new = F.when(F.col("__spans").isNotNull(), masked).otherwise(F.col("text"))
    cols = [new.alias(c) if c == "text" else
            F.when(F.col("__spans").isNotNull(), F.length(masked).cast(docs.schema[c].dataType)).otherwise(F.col(c)).alias(c)
            if c == "n_chars" else F.col(c) for c in docs.columns]
    return joined.select(*cols)
