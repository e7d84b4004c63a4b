"""Line dedup, token alignment and the Merkle manifest against brute force, round trips and odd rows."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
LINE, OTHER = "a line that many documents hold", "x" * 9
LONG = "\n".join(f"line number {i} of a long text" for i in range(5000))
TEXTS = [(1, f"{LINE}\nown line of document 1\n{OTHER}", "a"), (2, None, "a"), (3, "", None), (4, LONG, "b"), (5, LONG, "b"),
         (5, LONG, "b"), (None, f"  {LINE.upper()}\t\nlast", "c"), (7, "\n\n \r\n", "c"), (9, f"{OTHER}\n{LINE}", None),
         (9, "éé ßß \U0001F600 x ▁ <|endoftext|> <s>", "a"), (10, f"{LINE}\n{LINE}", "é")]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = ["line", "pos", "key", "rank", "leaf", "node", "grp", "path", "block", "pairs", "count", "gone", "h1", "doc", "id", "at"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, s, "src", None if t is None else len(t)) for i, t, s in TEXTS]
    return spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(f"extra {c}") for c in CLASH}).repartition(3)


# -- lines ---------------------------------------------------------------------------

def _key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))


def _kept_lines(rows, min_chars=10, min_documents=2):
    held = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(_key(line)) >= min_chars:
                held[_key(line)].add(i)
    first = {k: min(v, key=lambda i: (i is None, i)) for k, v in held.items() if len(v) >= min_documents}
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if first.get(_key(x), i) == i or len(_key(x)) < min_chars]
        yield i, len(lines), len(lines) - len(kept), "\n".join(kept)


@pytest.mark.parametrize("heavy_share", [1, 20000])
def test_line_dedup(docs, heavy_share):
    """With a share of 1 nearly every key goes by the shuffle join, else every one by the broadcast of heavy keys."""
    from ledgerscope.llm.line_dedup import deduplicated_lines
    got = [tuple(r) for r in deduplicated_lines(docs, heavy_share=heavy_share).collect()]
    want = list(_kept_lines([(i, t) for i, t, _ in TEXTS]))
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert (10, 2, 2, "") in got and (None, 2, 1, "last") in got and (4, 5000, 0, LONG) in got and (5, 5000, 5000, "") in got


def test_line_dedup_keeps_columns(docs):
    from ledgerscope.llm.line_dedup import deduplicated_lines, drop_repeated_lines
    out = drop_repeated_lines(docs)
    assert out.columns == docs.columns
    rows = {r.doc_id: r for r in out.collect() if r.doc_id != 9}
    assert (rows[10].text, rows[10].n_chars, rows[10].key) == ("", 0, "extra key") and rows[2].text is None
    assert deduplicated_lines(docs.limit(0)).count() == 0 and drop_repeated_lines(docs.limit(0)).count() == 0


def test_line_dedup_thresholds(spark):
    from ledgerscope.llm.line_dedup import deduplicated_lines
    rng = random.Random(3)
    rows = [(i, "\n".join(rng.choice(["alpha", "Beta ", " beta", "gamma gamma", "Ünïcode", "\tdelta\r"]) + rng.choice(["", "1"])
                          for _ in range(rng.randrange(6)))) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for chars, many in ((1, 2), (5, 30), (6, 12)):
        got = [tuple(r) for r in deduplicated_lines(df, min_chars=chars, min_documents=many, heavy_share=7).collect()]
        assert sorted(got) == sorted(_kept_lines(rows, chars, many))


# -- tokens ---------------------------------------------------------------------------

@settings(max_examples=300, deadline=None)
@given(st.sets(st.integers(1, 60)), st.sets(st.integers(1, 60)), st.integers(1, 9))
def test_merge_path_pieces_find_every_common_end(a, b, piece):
    from ledgerscope.llm.token_align import common_ends, on_diagonal
    x, y = np.array(sorted(a), np.int64), np.array(sorted(b), np.int64)
    both = np.array(sorted(a & b), np.int64)
    i, j = common_ends(x, y, piece)
    assert list(i) == list(np.searchsorted(x, both) + 1) and list(j) == list(np.searchsorted(y, both) + 1)
    merged = sorted([(v, 0) for v in a] + [(v, 1) for v in b])
    assert [on_diagonal(x, y, d) for d in range(len(merged) + 1)] == [sum(1 - s for _, s in merged[:d]) for d in range(len(merged) + 1)]


def _vocabularies():
    import sentencepiece
    from tokenizers import Tokenizer

    from ledgerscope.llm.token_align import FOLDER, VOCABULARIES
    a = Tokenizer.from_file(f"{FOLDER}/{VOCABULARIES[0]}")
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=f"{FOLDER}/{VOCABULARIES[1]}")


def _aligned(texts):
    """Brute force with the tokenizers library and a two-pointer walk; texts are (id, text) rows."""
    from ledgerscope.llm.token_align import _byte_of_char
    a, b = _vocabularies()
    at, seen, rows = _byte_of_char(), Counter(), []
    for i, t in texts:
        x, y = (a.encode(" " + t, add_special_tokens=False).ids, b.encode(t)) if t else ([], [])
        px = [bytes(at[c] for c in a.id_to_token(k)) for k in x]
        py = [bytes([int(b.id_to_piece(k)[3:5], 16)]) if b.is_byte(k) else b.id_to_piece(k).replace("▁", " ").encode() for k in y]
        if not t or b"".join(px) != (" " + t).encode() or b"".join(py) != (" " + t).encode():
            rows.append((i, None))
            continue
        groups, gx, gy, ex, ey, n, m = [], [], [], 0, 0, 0, 0
        while n < len(x) or m < len(y):
            if ex <= ey and n < len(x):
                gx, ex, n = gx + [x[n]], ex + len(px[n]), n + 1
            else:
                gy, ey, m = gy + [y[m]], ey + len(py[m]), m + 1
            if ex == ey and gx and gy:
                groups.append((gx, gy))
                gx, gy = [], []
        links = Counter((p, q) for u, v in groups for p in u for q in v)
        seen.update(links.keys())
        rows.append((i, (x, y, groups, links)))
    top = Counter()
    for (p, _), c in seen.items():
        top[p] = max(top[p], c)
    for i, found in rows:
        if found is None:
            yield (i, 0, 0, 0, 0, 0, 0, "")
            continue
        x, y, groups, links = found
        text = ";".join(",".join(map(str, u)) + "|" + ",".join(map(str, v)) for u, v in groups)
        yield (i, len(x), len(y), len(groups), sum(links.values()), sum(n for k, n in links.items() if seen[k] == top[k[0]]),
               sum(n * seen[k] for k, n in links.items()), hashlib.sha256(text.encode()).hexdigest())


def test_token_alignment(spark):
    from ledgerscope.llm.queries import QUERIES
    texts = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = [tuple(r) for r in QUERIES["op12_token_alignment"](spark, SF).collect()]
    assert sorted(got) == sorted(_aligned(texts))


@pytest.mark.parametrize("block_bytes", [40, 4 << 20])
def test_token_alignment_of_odd_rows(spark, docs, block_bytes, monkeypatch):
    from ledgerscope.llm import token_align
    rows = [(20, "a" * 30000), (21, " " * 3000), (22, "漢字" * 400 + "\x00\x07"), (23, "zß☃\U0001F600‍" * 50)]
    more = docs.select("doc_id", "text").unionByName(spark.createDataFrame(rows, "doc_id long, text string"))
    got = [tuple(r) for r in token_align.aligned_documents(more, block_bytes=block_bytes).collect()]
    want = list(_aligned([(i, t) for i, t, _ in TEXTS] + rows))
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert (9, 0, 0, 0, 0, 0, 0, "") in got  # U+2581 comes back as a space
    assert token_align.aligned_documents(docs.limit(0)).count() == 0


def test_links_of_large_groups_are_counted_by_distinct_ids(monkeypatch):
    from ledgerscope.llm import token_align as T
    coder = T.Aligner(T.Vocabulary([b"a", b"aa", b"b"], lambda t: [0] * t.count("a")),
                      T.Vocabulary([b" ", b"aaa"], lambda t: [1] * (t.count("a") // 3)))
    ids = np.zeros(12, np.int64)
    args = (ids, np.ones(4, np.int64), np.array([3, 12]), np.array([1, 4]), np.array([3, 9]), np.array([1, 3]), np.array([0, 0]))
    want = [x.tolist() for x in coder._pairs(*args)]
    monkeypatch.setattr(T, "LINKS_AT_ONCE", 1)
    assert [x.tolist() for x in coder._pairs(*args)] == want == [[1], [1], [0], [0], [30]]


# -- manifest ---------------------------------------------------------------------------

def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _leaf(row, lower=False):
    def one(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"
    text = row["text"]
    if lower and text is not None:
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    return _h(*[one(v) for v in (row["doc_id"], row["source"], row["lang"], row["n_chars"], text)])


def _tree(nodes):
    """Levels from the nodes up to the last one."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([_h(*levels[-1][k:k + 8]) for k in range(0, len(levels[-1]), 8)])
    return levels


def _siblings(levels, at):
    for level in levels[:-1]:
        run = level[at // 8 * 8:at // 8 * 8 + 8]
        yield run[:at % 8], run[at % 8 + 1:]
        at //= 8


def _manifest(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r["lang"]].append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        groups[g].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, _leaf(r)))
        trees[g] = _tree([_leaf(r) for r in groups[g]])
    top = _tree([trees[g][-1][0] for g in names])
    for q, g in enumerate(names):
        for at, r in enumerate(groups[g]):
            path = [*_siblings(trees[g], at), *_siblings(top, q)]
            i = r["doc_id"]
            node = _leaf(r, i is not None and zlib.crc32(str(i).encode()) % 3 == 0)
            for left, right in path:
                node = _h(*left, node, *right)
            yield (i, _leaf(r), trees[g][-1][0], top[-1][0], _h(*[x for left, right in path for x in left + right]), node, node == top[-1][0])


def _audit(df):
    from ledgerscope.llm.merkle import audited
    tampered = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3) == 0
    return [tuple(r) for r in audited(df, tampered).select(
        "doc_id", "leaf", "subroot", "root", F.sha2("proof", 256), "folded_root", "verified").collect()]


def test_manifest_of_odd_rows(docs):
    want = list(_manifest([r.asDict() for r in docs.collect()]))
    assert sorted(_audit(docs), key=repr) == sorted(want, key=repr)
    assert _audit(docs.limit(0)) == []
    one = docs.filter("doc_id = 3")
    assert _audit(one) == list(_manifest([one.first().asDict()]))  # a lone leaf is its own root


@pytest.mark.parametrize("sizes", [(1, 8, 9, 65), (700,), (2,) * 20])
def test_manifest_heights(spark, sizes):
    """Languages of different heights side by side, and more than one level of languages."""
    rows = [{"doc_id": 100 * k + i, "text": f"Text {i % 5}" if i % 7 else None, "lang": None if k == 0 else f"l{k}", "source": "s",
             "n_chars": i} for k, n in enumerate(sizes) for i in range(n)]
    df = spark.createDataFrame([tuple(r[c] for c in ("doc_id", "text", "lang", "source", "n_chars")) for r in rows], SCHEMA)
    got = _audit(df.repartition(5))
    assert sorted(got) == sorted(_manifest(rows))
    assert {r[6] for r in got} == {True, False} or len(got) < 30


def test_proofs_of_requested_leaves_only(spark):
    from ledgerscope.llm.merkle import build, folded, leaves, proofs
    df = spark.range(600).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), "id").alias("text"),
                                 F.when(F.col("id") % 5 == 0, "x").otherwise("y").alias("lang"), F.lit("s").alias("source"), F.lit(2).alias("n_chars"))
    rows = leaves(df).cache()
    manifest = build(rows)
    wanted = rows.filter("id % 97 = 3").select("grp", "rank")
    got = proofs(manifest, rows, wanted).withColumn("root", folded(F.col("leaf"), F.col("path"))).collect()
    assert sorted(r.id for r in got) == list(range(3, 600, 97)) and {r.root for r in got} == {manifest.root}
    assert got[0].leaf != got[1].leaf and all(len(r.path) == len(got[0].path) or r.grp != got[0].grp for r in got)
