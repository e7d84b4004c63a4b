"""Exact removal of repeated substrings with suffix arrays.

Every byte covered by a string of ``length`` bytes that also starts earlier (in
an earlier document, or earlier in the same one) is removed; whole texts, all
documents, judged on the input.

Partitioning. The smallest k-gram hash among a string's first positions (its
anchor, leftmost on ties) depends on the string alone, so equal strings share
their anchor. Consecutive strings with one anchor form a run, and a document is a row of runs.
Runs travel as (anchor, content hash, document, start), never as text. Copies
of a run fall together by hash: all but the first are removed whole, already
inside each map batch, so a passage that a third of all documents share reaches
a task once per batch; k-grams common to a bounded sample of documents are anchors
only where a string holds no other (see ``Common``). Runs that share the anchor but not the content (a copy's
edited spots, a passage's ends) send their bytes to the anchor's task.

There, the runs' words form one integer text, and its suffix array is built by
the linear grouping construction of ``gsaca``: groups of suffixes with a common
Lyndon context, visited in descending order along previous-smaller pointers,
then emitted in order. A string is identified by the first word start inside it:
neighbours in the array whose common prefix reaches its end, with equal bytes
before that word start, are the same string; the earliest stays. Where a
string's first 64 bytes hold no word end, its anchor's runs are sorted by bytes.
What the sort removes is verified byte by byte against the string that stays; copies
that hashing settles rest on 56 bits of content hash and the anchor.

Order and defined cases: documents are ordered by doc_id, nulls last; rows that share
an id are ordered by content, and equal ones among them are one document (equal
results). Null texts are empty; texts
under ``length`` bytes keep all; extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerscope.llm.common import Shipped, running, stage, utf8
from ledgerscope.llm.gsaca import suffix_array

LENGTH = 100
GRAM = 28
RANKED = 1 << 62
WORD_END = 64  # a word ends (a byte up to 0x20) among so many first bytes, or the anchor's runs are sorted by bytes
PIECE = 1 << 19  # strings looked at together
COMMON_DOCS = 20  # k-grams of so many sampled texts (and 1 % of them) are common
SAMPLE_DOCS, SAMPLE_CHARS = 2000, 20_000
SORT_BYTES = 1 << 22  # run bytes sorted together; one anchor's runs may exceed it
_U = np.uint64
_MULT = 0x9E3779B97F4A7C15
_BYTES = np.random.default_rng(20240229).integers(1, 2 ** 63, 256, dtype=np.int64).astype(_U)


class _Rolling:
    """64-bit polynomial hashes of all substrings of one length: differences of prefix sums, scaled."""

    up = np.ones(1, _U)
    down = np.ones(1, _U)

    @classmethod
    def powers(cls, n):
        if len(cls.up) <= n:
            m = max(n + 1, 2 * len(cls.up))
            cls.up = np.cumprod(np.r_[_U(1), np.full(m, _U(_MULT))])
            cls.down = np.cumprod(np.r_[_U(1), np.full(m, _U(pow(_MULT, -1, 2 ** 64)))])
        return cls.up, cls.down

    def __init__(self, data: np.ndarray):
        self.scale, down = self.powers(len(data))
        self.sums = np.r_[_U(0), np.cumsum(_BYTES[data] * down[:len(data)])]

    def at(self, starts, lengths):
        # Scaling by the inverse power leaves a hash of the content alone.
        h = (self.sums[starts + lengths] - self.sums[starts]) * self.scale[starts]
        h ^= h >> _U(29)
        h *= _U(0xBF58476D1CE4E5B9)
        return h ^ (h >> _U(32))


def _sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    n = len(x)
    pad = np.full(-(-n // w) * w, np.iinfo(np.int64).max)
    pad[:n] = x
    pad = pad.reshape(-1, w)
    ahead = np.minimum.accumulate(pad, axis=1).ravel()
    back = np.minimum.accumulate(pad[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n - w + 1], ahead[w - 1:n])


class Common:
    """k-gram hashes that are anchors only where a string holds no other: the ends of a
    passage that very many documents share are then anchored in the text around it,
    which differs, and do not all meet in the passage's task."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = np.sort(hashes)
        self.bloom = np.zeros(1 << 20, bool)
        self.bloom[self.hashes >> _U(44)] = True

    def among(self, grams: np.ndarray) -> np.ndarray:
        out = self.bloom[grams >> _U(44)]
        at = np.flatnonzero(out)
        if len(at):
            near = np.minimum(np.searchsorted(self.hashes, grams[at]), len(self.hashes) - 1)
            out[at] = self.hashes[near] == grams[at]
        return out


def common_grams(texts: list, gram: int = GRAM) -> Common:
    """The k-grams of at least 1 % (and COMMON_DOCS) of these texts."""
    found = []
    for t in texts:
        b = np.frombuffer(utf8(t), np.uint8)
        if len(b) >= gram:
            found.append(np.unique(_Rolling(b).at(np.arange(len(b) - gram + 1), gram)))
    if not found:
        return Common(np.zeros(0, _U))
    hashes, n = np.unique(np.concatenate(found), return_counts=True)
    return Common(hashes[n >= max(COMMON_DOCS, len(texts) // 100)])


def runs_of(data: np.ndarray, ends: np.ndarray, length: int = LENGTH, gram: int = GRAM, common: Common | None = None):
    """(anchor hash, content hash, start, strings) of the runs of concatenated texts that end at ``ends``."""
    empty = (np.zeros(0, np.int64),) * 4
    if len(data) < length:
        return empty
    roll = _Rolling(data)
    grams = roll.at(np.arange(len(data) - gram + 1), gram)
    bits = int(len(grams)).bit_length()
    key = ((grams >> _U(bits + 2)) << _U(bits)).astype(np.int64) | np.arange(len(grams))
    if common is not None and len(common.hashes):
        key |= common.among(grams).astype(np.int64) << 62
    pos = _sliding_min(key, length - gram + 1) & ((1 << bits) - 1)
    owner = np.searchsorted(ends, np.arange(len(pos)), side="right")
    whole = np.arange(len(pos)) + length <= ends[owner]
    first = np.flatnonzero(whole & np.r_[True, (pos[1:] != pos[:-1]) | ~whole[:-1]])
    if not len(first):
        return empty
    stop = np.flatnonzero(whole & np.r_[(pos[1:] != pos[:-1]) | ~whole[1:], True])
    n = stop - first + 1
    content = roll.at(first, n + length - 1)
    return grams[pos[first]].view(np.int64), ((content >> _U(8)) << _U(7)).astype(np.int64) | n, first, n


def _pieces(texts, dids, length):
    """Concatenations of about PIECE bytes: (bytes, ends, document of each, offset of each in its text)."""
    data, ends, who, offs, size = [], [], [], [], 0
    for t, d in zip(texts, dids):
        b = np.frombuffer(utf8(t), np.uint8)
        for off in range(0, max(len(b) - length + 1, 0), PIECE):
            part = b[off:off + PIECE + length - 1]
            data.append(part)
            size += len(part)
            ends.append(size)
            who.append(d)
            offs.append(off)
            if size > PIECE:
                yield np.concatenate(data), np.array(ends), np.array(who), np.array(offs)
                data, ends, who, offs, size = [], [], [], [], 0
    if data:
        yield np.concatenate(data), np.array(ends), np.array(who), np.array(offs)


def merge(starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal unions of half-open intervals (touching ones join)."""
    if not len(starts):
        return starts, stops
    o = np.argsort(starts, kind="stable")
    s, e = starts[o], np.maximum.accumulate(stops[o])
    cut = np.flatnonzero(s[1:] > e[:-1]) + 1
    return s[np.r_[0, cut]], e[np.r_[cut - 1, len(e) - 1]]


_RUNS = "anchor long, content long, did long, start long"
_MARK = -1  # content of a row that is a removed interval: anchor spreads it, start and the content's rest hold it


def _merge_by_doc(did, start, stop):
    """Intervals merged inside each document, all at once: documents are laid out one after another."""
    if not len(did):
        return did, start, stop
    o = np.lexsort((start, did))
    did, start, stop = did[o], start[o], stop[o]
    first = np.flatnonzero(np.r_[True, did[1:] != did[:-1]])
    reach = int(stop.max()) + 2
    shift = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(did)])) * reach
    s, e = merge(start + shift, stop + shift)
    k = s // reach
    return did[first][k], s - k * reach, e - k * reach


def _map_runs(length, gram, common):
    def run(batches):
        shared = common.value
        for pdf in batches:
            parts = []
            for data, ends, who, offs in _pieces(pdf["text"], pdf["did"].tolist(), length):
                a, c, first, n = runs_of(data, ends, length, gram, shared)
                own = np.searchsorted(ends, first, side="right")
                begin = np.r_[0, ends[:-1]]
                parts.append((a, c, who[own], first - begin[own] + offs[own]))
            if not parts:
                continue
            a, c, d, s = (np.concatenate([p[i] for p in parts]) for i in range(4))
            o = np.lexsort((s, d, c, a))
            a, c, d, s = a[o], c[o], d[o], s[o]
            again = np.r_[False, (a[1:] == a[:-1]) & (c[1:] == c[:-1])]
            keep = ~again
            yield pd.DataFrame({"anchor": a[keep], "content": c[keep], "did": d[keep], "start": s[keep]})
            md, ms, me = _merge_by_doc(d[again], s[again], s[again] + (c[again] & 127) + length - 1)
            if len(md):
                spread = (md.astype(_U) * _U(_MULT) + ms.astype(_U)).view(np.int64)
                yield pd.DataFrame({"anchor": spread, "content": _MARK - (me - ms), "did": md, "start": ms})
    return run


_FOUND = "did long, start long, stop long, anchor long"  # anchor is null for removed intervals


def _meet(length):
    """Rows sorted by anchor, content, document, start: removed intervals, and first runs of anchors with several contents."""
    def close(a, c, d, s):
        mark = c < 0
        out_d, out_s, out_e = [d[mark]], [s[mark]], [s[mark] + (_MARK - c[mark])]
        a, c, d, s = a[~mark], c[~mark], d[~mark], s[~mark]
        new_a = np.r_[True, a[1:] != a[:-1]] if len(a) else np.zeros(0, bool)
        new_c = new_a | np.r_[True, c[1:] != c[:-1]] if len(a) else new_a
        stop = s + (c & 127) + length - 1
        out_d.append(d[~new_c])
        out_s.append(s[~new_c])
        out_e.append(stop[~new_c])
        kinds = np.add.reduceat(new_c, np.flatnonzero(new_a)) if len(a) else np.zeros(0, int)
        several = new_c & (kinds > 1)[np.cumsum(new_a) - 1] if len(a) else new_c
        md, ms, me = _merge_by_doc(*(np.concatenate(x) for x in (out_d, out_s, out_e)))
        gone = pd.DataFrame({"did": md, "start": ms, "stop": me, "anchor": pd.array([None] * len(md), "Int64")})
        open_ = pd.DataFrame({"did": d[several], "start": s[several], "stop": stop[several],
                              "anchor": pd.array(a[several], "Int64")})
        return pd.concat([gone, open_], ignore_index=True)

    def run(batches):
        held = None
        for pdf in batches:
            if not len(pdf):
                continue
            rows = [pdf[x].to_numpy(np.int64) for x in ("anchor", "content", "did", "start")]
            if held is not None:
                rows = [np.concatenate(x) for x in zip(held, rows)]
            a, c = rows[0], rows[1]
            if a[0] == a[-1]:
                # Still one anchor: copies of one content need only its first row.
                keep = np.r_[True, c[1:] != c[:-1]]
                drop = ~keep
                if drop.any():
                    d, s = rows[2][drop], rows[3][drop]
                    md, ms, me = _merge_by_doc(d, s, np.where(c[drop] < 0, s + (_MARK - c[drop]), s + (c[drop] & 127) + length - 1))
                    yield pd.DataFrame({"did": md, "start": ms, "stop": me, "anchor": pd.array([None] * len(md), "Int64")})
                held = [x[keep] for x in rows]
                continue
            last = int(np.searchsorted(a, a[-1]))
            yield close(*(x[:last] for x in rows))
            held = [x[last:] for x in rows]
        if held is not None:
            yield close(*held)
    return run


def _cut_runs(batches):
    """Bytes of the open runs of each document."""
    import zstandard

    unpack = zstandard.ZstdDecompressor()
    for pdf in batches:
        rows = []
        for did, blob, runs in zip(pdf["did"], pdf["blob"], pdf["runs"]):
            b = unpack.decompress(blob)
            rows += [(r["anchor"], did, r["start"], b[r["start"]:r["stop"]]) for r in runs]
            if len(rows) > 50_000:
                yield pd.DataFrame(rows, columns=["anchor", "did", "start", "bytes"])
                rows = []
        if rows:
            yield pd.DataFrame(rows, columns=["anchor", "did", "start", "bytes"])


def repeated_windows(anchor, did, start, texts: list[bytes], length: int = LENGTH):
    """(document, start) of the strings of these runs that start earlier in another of the runs; both arrays."""
    sizes = np.array([len(t) for t in texts])
    data = np.frombuffer(b"".join(texts), np.uint8)
    begin = np.r_[0, np.cumsum(sizes)[:-1]]
    # Only stretches whose strings occur twice by hash need sorting; the rest cannot repeat.
    windows = np.concatenate([np.arange(b, b + n - length + 1) for b, n in zip(begin, sizes)])
    of = np.repeat(np.arange(len(texts)), sizes - length + 1)
    h = _Rolling(data).at(windows, length)
    o = np.argsort(h, kind="stable")
    same = h[o][1:] == h[o][:-1]
    twice = np.zeros(len(h), bool)
    twice[o[1:][same]] = True
    twice[o[:-1][same]] = True
    none = np.zeros(0, np.int64)
    if not twice.any():
        return none, none
    windows, of = windows[twice], of[twice]
    edge = np.flatnonzero(np.r_[True, (windows[1:] != windows[:-1] + 1) | (of[1:] != of[:-1])])
    lo, hi = windows[edge], np.r_[windows[edge[1:] - 1], windows[-1]] + length
    run = of[edge]
    stretch: dict = {}  # equal stretches are one text; the earliest stands for them
    order = np.lexsort((start[run] + lo - begin[run], did[run]))
    copies = []
    for k in order:
        b = data[lo[k]:hi[k]].tobytes()
        kept = stretch.setdefault((int(anchor[run[k]]), b), k)
        if kept != k:
            copies.append(k)
    gone_d, gone_s = [], []
    for k in copies:
        n = hi[k] - lo[k] - length + 1
        gone_d.append(np.full(n, did[run[k]]))
        gone_s.append(start[run[k]] + lo[k] - begin[run[k]] + np.arange(n))
    firsts = list(stretch.values())
    plain: dict = {}
    for k in firsts:
        part = data[lo[k]:hi[k]]
        ends = np.flatnonzero(part <= 32)
        bound = len(part) - length + WORD_END  # a word end before here serves the last string too
        gaps = np.diff(np.r_[-1, ends[ends < bound], bound])
        plain[int(anchor[run[k]])] = plain.get(int(anchor[run[k]]), True) and gaps.max(initial=WORD_END + 1) <= WORD_END
    for by_word in (True, False):
        ks = [k for k in firsts if plain[int(anchor[run[k]])] == by_word]
        if ks:
            d, s = _sorted_windows([data[lo[k]:hi[k]] for k in ks], did[run[ks]], start[run[ks]] + lo[ks] - begin[run[ks]], length, by_word)
            gone_d.append(d)
            gone_s.append(s)
    return (np.concatenate(gone_d), np.concatenate(gone_s)) if gone_d else (none, none)


def _sorted_windows(parts, did, start, length, by_word):
    """Repeated strings of distinct stretches, from the suffix array of their words (or bytes)."""
    size = np.array([len(p) for p in parts])
    data = np.concatenate(parts)
    begin = np.r_[0, np.cumsum(size)[:-1]]
    symbols: dict = {}
    cut, own, names = [], [], []
    for k, (p, b) in enumerate(zip(parts, begin)):
        ends = np.flatnonzero(p <= 32) + 1 if by_word else np.arange(1, len(p) + 1)
        if not len(ends) or ends[-1] != len(p):
            ends = np.r_[ends, len(p)]
        at = np.r_[0, ends[:-1]]
        raw = p.tobytes()
        names += [raw[x:y] for x, y in zip(at.tolist(), ends.tolist())]
        names.append(b"")  # ends the stretch; sorts before every word
        cut.append(np.r_[b + at, -1])
        own.append(np.full(len(at) + 1, k))
    cut, own = np.concatenate(cut), np.concatenate(own)
    for i, w in enumerate(sorted(set(names))):
        symbols[w] = i
    sa = np.array(suffix_array([symbols[w] for w in names]))
    sa = sa[cut[sa] >= 0]
    at, k = cut[sa], own[sa]
    rest = begin[k] + size[k] - at  # bytes to the end of the stretch
    pad = np.r_[data, np.zeros(length, np.uint8)]
    common = np.zeros(len(at), np.int64)  # with the entry before, by direct comparison
    view = np.lib.stride_tricks.sliding_window_view(pad, length)
    for i in range(1, len(at), 1 << 16):
        x, y = view[at[i:i + (1 << 16)]], view[at[i - 1:i - 1 + (1 << 16)][:len(at[i:i + (1 << 16)])]]
        differ = x != y
        common[i:i + (1 << 16)] = np.where(differ.any(axis=1), differ.argmax(axis=1), length)
    common[1:] = np.minimum(common[1:], np.minimum(rest[1:], rest[:-1]))
    before = at - np.r_[0, cut[:-1]][sa]  # bytes of the word that ends where this suffix starts
    before = np.where(at == begin[k], 0, before)
    left = _Rolling(data)
    rank = np.unique(did, return_inverse=True)[1]
    gone_d, gone_s = [], []
    offsets = range(1, int(before.max(initial=0)) + 1) if by_word else range(0, 1)
    for o in offsets:
        chain = np.cumsum(common < length - o)
        pick = np.flatnonzero((before >= o) & (rest >= length - o)) if by_word else np.flatnonzero(rest >= length)
        if len(pick) < 2:
            continue
        p = at[pick] - o
        tag = left.at(p, o) if o else np.zeros(len(p), _U)
        tag = tag ^ (chain[pick].astype(_U) * _U(_MULT))
        begins = start[k[pick]] + p - begin[k[pick]]
        order = np.lexsort((begins, rank[k[pick]], tag))
        t, q = tag[order], pick[order]
        first = np.flatnonzero(np.r_[True, t[1:] != t[:-1]])
        head = np.repeat(first, np.diff(np.r_[first, len(t)]))
        late = np.flatnonzero(head != np.arange(len(t)))
        if not len(late):
            continue
        x, y = view[at[q[late]] - o], view[at[q[head[late]]] - o]
        late = late[(x == y).all(axis=1)]
        gone_d.append(did[k[q[late]]])
        gone_s.append(begins[order][late])
    none = np.zeros(0, np.int64)
    return (np.concatenate(gone_d), np.concatenate(gone_s)) if gone_d else (none, none)


def _sort_runs(length):
    def run(batches):
        held, size = None, 0

        def close(pdf):
            d, s = repeated_windows(pdf["anchor"].to_numpy(np.int64), pdf["did"].to_numpy(np.int64), pdf["start"].to_numpy(np.int64),
                                    pdf["bytes"].tolist(), length)
            md, ms, me = _merge_by_doc(d, s, s + length)
            return pd.DataFrame({"did": md, "start": ms, "stop": me})

        for pdf in batches:
            if not len(pdf):
                continue
            lens = pdf["bytes"].map(len).to_numpy()
            lo = 0
            while lo < len(pdf):
                # up to SORT_BYTES more, then to the end of the anchor in hand
                hi = lo + int(np.searchsorted(np.cumsum(lens[lo:]), max(SORT_BYTES - size, 1))) + 1
                part = pdf.iloc[lo:hi]
                held = part if held is None else pd.concat([held, part], ignore_index=True)
                size += int(lens[lo:hi].sum())
                lo = hi
                if size >= SORT_BYTES:
                    a = held["anchor"].to_numpy()
                    last = int(np.flatnonzero(a != a[-1])[-1]) + 1 if (a != a[-1]).any() else 0
                    if last:
                        yield close(held.iloc[:last])
                        held = held.iloc[last:]
                        size = int(held["bytes"].map(len).sum())
        if held is not None and len(held):
            yield close(held)
    return run


_RESULT = T.StructType([T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()),
                        T.StructField("n_spans", T.LongType()), T.StructField("kept", T.BinaryType()),
                        T.StructField("kept_sha256", T.StringType())])


def _apply(keep_text):
    @F.pandas_udf(_RESULT)
    def apply(blobs: pd.Series, gone: pd.Series) -> pd.DataFrame:
        import zstandard

        unpack = zstandard.ZstdDecompressor()
        rows = []
        for blob, spans in zip(blobs, gone):
            b = unpack.decompress(blob)
            kept, removed, n = b, 0, 0
            if spans is not None and len(spans):
                s, e = merge(np.array([x["start"] for x in spans]), np.array([x["stop"] for x in spans]))
                kept = b"".join(b[i:j] for i, j in zip(np.r_[0, e].tolist(), np.r_[s, len(b)].tolist()))
                removed, n = int((e - s).sum()), len(s)
            rows.append((len(b), removed, n, kept if keep_text else None, hashlib.sha256(kept).hexdigest()))
        return pd.DataFrame(rows, columns=_RESULT.names)
    return apply


@F.pandas_udf(T.BinaryType())
def _pack(texts: pd.Series) -> pd.Series:
    import zstandard

    pack = zstandard.ZstdCompressor(level=3)
    return pd.Series([pack.compress(utf8(t)) for t in texts])


def _ordered(docs: DataFrame) -> DataFrame:
    """(doc_id, text, did): did orders the documents. Where ids are null or repeated, documents are
    the distinct (doc_id, text) by id, nulls last, and content; did is their rank, from ``RANKED`` on."""
    odd = docs.groupBy("doc_id").count().filter("count > 1 or doc_id is null")
    if not odd.limit(1).count():
        return docs.withColumn("did", F.col("doc_id").cast("long"))
    keyed = docs.withColumn("__th", F.xxhash64(F.coalesce("text", F.lit(""))))
    own = keyed.select(F.col("doc_id").alias("__own"), F.col("__th").alias("__oth")).distinct()
    ranked = stage(running(own, [F.col("__own").asc_nulls_last(), F.col("__oth")], {"__rank": F.lit(1).cast("long")}), "ranked")
    return (keyed.join(ranked, F.col("doc_id").eqNullSafe(F.col("__own")) & (F.col("__th") == F.col("__oth")))
            .select("doc_id", "text", (F.col("__rank") + RANKED).alias("did")))


def _sample(src: DataFrame) -> list:
    """Texts of at most SAMPLE_DOCS documents in hash order (each of at most SAMPLE_CHARS
    characters). They only choose anchors: every anchor choice gives the same result."""
    short = src.filter(F.length("text") <= SAMPLE_CHARS)
    ids = short.select("did").distinct().orderBy(F.xxhash64("did"), "did").limit(SAMPLE_DOCS).collect()
    if not ids:
        return []
    wanted = F.broadcast(src.sparkSession.createDataFrame([(r.did,) for r in ids], "did long"))
    return [r.text for r in short.join(wanted, "did").groupBy("did").agg(F.min("text").alias("text")).collect()]


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM,
                   keep_text: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256
    and, with ``keep_text``, kept: the bytes that remain."""
    src = _ordered(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")))
    common = Shipped(docs.sparkSession, common_grams(_sample(src), gram))
    runs = src.select("did", "text").mapInPandas(_map_runs(length, gram, common), _RUNS)
    found = stage(runs.repartition("anchor").sortWithinPartitions("anchor", "content", "did", "start")
                  .mapInPandas(_meet(length), _FOUND), "found")
    packed = src.select("doc_id", "did", _pack("text").alias("blob"))
    open_ = (found.filter("anchor is not null").groupBy("did")
             .agg(F.collect_list(F.struct("anchor", "start", "stop")).alias("runs")))
    # One blob per document here: equal rows are one document and would only repeat each other's runs.
    texts = packed.select("did", "blob").join(open_, "did")
    texts = texts.filter(F.col("did") < RANKED).union(texts.filter(F.col("did") >= RANKED).dropDuplicates(["did"]))
    sorted_ = stage(texts.mapInPandas(_cut_runs, "anchor long, did long, start long, bytes binary")
                    .repartition("anchor").sortWithinPartitions("anchor")
                    .mapInPandas(_sort_runs(length), "did long, start long, stop long"), "sorted")
    gone = (found.filter("anchor is null").select("did", "start", "stop").union(sorted_)
            .groupBy("did").agg(F.collect_list(F.struct("start", "stop")).alias("gone")))
    out = packed.join(gone, "did", "left").select("doc_id", _apply(keep_text)("blob", "gone").alias("r"))
    return out.select("doc_id", *[f"r.{c}" for c in ("n_bytes", "n_removed", "n_spans", "kept_sha256")],
                      *(["r.kept"] if keep_text else []))
