"""Cross-tokenizer alignment: which tokens of two vocabularies cover the same bytes.

Both tokenizers cut one byte string, a space and the text. Byte offsets where a
token of A and a token of B both end cut the tokens into groups; all pairs of an
A token and a B token of one group are linked.

Merge path: the A ends and the B ends of a block of documents are two sorted
lists (each document's offsets follow the one before). Merging them is divided
on equally spaced diagonals: a binary search finds how many A ends and B ends
lie before each diagonal, so every piece merges the same number of ends,
whatever the lengths of the documents. A piece emits the ends that both lists
have. What a piece leaves open at its last cut is closed by the next piece's first
one, and an end that stands on both sides of a diagonal is a cut between pieces.

Corpus counts: a block's distinct pairs, with the number of its documents that
hold each, are one row; pairs are summed over blocks, the highest count of each
A id is found, and every block gets back the counts of its own pairs. So the
corpus table is joined per block, not per document, and a pair that every
document holds is one row a block. Documents' links are kept as positions in
their block's pairs.

Defined cases: null and empty texts, and texts whose token bytes differ from
space + text, have no tokens: zeros and an empty digest; every row is a document
of its own, repeated rows and ids too; null ids stay null; strings of special
tokens are plain text; an empty table gives an empty table; extra columns are
ignored. A block holds ``BLOCK_BYTES`` of text, or one longer document.
"""

from __future__ import annotations

import hashlib
import json
import os

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerscope.llm.common import stage

FOLDER = "/opt/tokenizers"
VOCABULARIES = ("byte_bpe_50k.json", "piece_bpe_32k.model")
BLOCK_BYTES = 4 << 20
PIECE = 1 << 16       # ends merged by one piece
LINKS_AT_ONCE = 1 << 19
# Fixed value: the pattern that cuts text before the merges of the byte-level vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


# -- tokenizers ------------------------------------------------------------------

def _byte_of_char() -> dict:
    """The byte-level alphabet: printable bytes stand for themselves, the others for the code points from 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """``encode(text)`` gives a list of ids; ``pieces`` each id's bytes."""

    def __init__(self, pieces, encode):
        self.pieces, self.encode = pieces, encode
        self.lengths = np.array([len(p) for p in pieces], np.int64)


def byte_level(spec: bytes) -> Vocabulary:
    """A byte-level BPE from its JSON: ids follow the order of the merges, so they are the ranks."""
    import tiktoken
    spec = json.loads(spec)
    special, at = {t["id"] for t in spec["added_tokens"]}, _byte_of_char()
    ranks = {bytes(at[c] for c in t): i for t, i in spec["model"]["vocab"].items() if i not in special}
    coder = tiktoken.Encoding("byte-level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    pieces = [b""] * (max(max(ranks.values()), max(special, default=0)) + 1)
    for p, i in ranks.items():
        pieces[i] = p
    return Vocabulary(pieces, lambda text: coder.encode_ordinary(" " + text))


def sentence_pieces(model: bytes) -> Vocabulary:
    import sentencepiece
    coder = sentencepiece.SentencePieceProcessor(model_proto=model)
    pieces = [bytes([int(coder.id_to_piece(i)[3:5], 16)]) if coder.is_byte(i)
              else coder.id_to_piece(i).replace("▁", " ").encode() for i in range(coder.get_piece_size())]
    return Vocabulary(pieces, coder.encode)


# -- merge path --------------------------------------------------------------------

def on_diagonal(a: np.ndarray, b: np.ndarray, d: int) -> int:
    """How many of the first ``d`` items of the merge of a and b are a's; of equal items a's come first."""
    lo, hi = max(0, d - len(b)), min(d, len(a))
    while lo < hi:
        mid = (lo + hi) // 2
        if a[mid] <= b[d - 1 - mid]:
            lo = mid + 1
        else:
            hi = mid
    return lo


def common_ends(a: np.ndarray, b: np.ndarray, piece: int = PIECE):
    """Numbers of a's and of b's ends up to and with each end that both have, in order."""
    total = len(a) + len(b)
    diagonals = [*range(0, total, piece), total]
    splits = [on_diagonal(a, b, d) for d in diagonals]
    cut_a, cut_b = [], []
    for d0, d1, i0, i1 in zip(diagonals, diagonals[1:], splits, splits[1:]):
        j0, j1 = d0 - i0, d1 - i1
        if i0 and j0 < len(b) and a[i0 - 1] == b[j0]:  # the equal ends stand on both sides of this diagonal
            cut_a.append(np.array([i0]))
            cut_b.append(np.array([j0 + 1]))
        x, y = a[i0:i1], b[j0:j1]
        if len(x) and len(y):
            at = np.minimum(np.searchsorted(y, x), len(y) - 1)
            same = np.flatnonzero(y[at] == x)
            cut_a.append(i0 + same + 1)
            cut_b.append(j0 + at[same] + 1)
    if not cut_a:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(cut_a).astype(np.int64), np.concatenate(cut_b).astype(np.int64)


# -- one block of documents ----------------------------------------------------------

_NONE = np.zeros(0, np.int32)


class Aligner:
    def __init__(self, a: Vocabulary, b: Vocabulary):
        self.a, self.b = a, b
        self.n_a, self.n_b = len(a.pieces), len(b.pieces)
        marks = [[f"{m}{i}".encode() for i in range(n)] for n, signs in ((self.n_a, ";,"), (self.n_b, "|,")) for m in signs]
        words = np.array([w for part in marks for w in part])
        self.marks = words.view(np.uint8).reshape(len(words), -1)
        self.mark_lengths = (self.marks != 0).sum(axis=1).astype(np.int8)

    def _tokens(self, text):
        """Ids of both tokenizers; none where their bytes are not space + text."""
        if not text:
            return _NONE, _NONE
        x, y, want = self.a.encode(text), self.b.encode(text), b" " + text.encode("utf-8", "surrogatepass")
        if b"".join([self.a.pieces[i] for i in x]) != want or b"".join([self.b.pieces[i] for i in y]) != want:
            return _NONE, _NONE
        return np.array(x, np.int32), np.array(y, np.int32)

    def block(self, texts) -> dict:
        """Per document its counts and digest; the block's pairs and, per document, its own among them."""
        found = [self._tokens(t) for t in texts]
        n = len(found)
        ta, tb = np.array([len(x) for x, _ in found], np.int64), np.array([len(y) for _, y in found], np.int64)
        ids_a, ids_b = np.concatenate([_NONE] + [x for x, _ in found]), np.concatenate([_NONE] + [y for _, y in found])
        del found
        # Each document's tokens cover all its bytes, so running lengths are offsets over the block.
        cut_a, cut_b = common_ends(np.cumsum(self.a.lengths[ids_a]), np.cumsum(self.b.lengths[ids_b]))
        size_a, size_b = np.diff(cut_a, prepend=0), np.diff(cut_b, prepend=0)
        doc = np.searchsorted(np.cumsum(ta), cut_a - 1, side="right")
        pairs, held, owner, place, times = self._pairs(ids_a, ids_b, cut_a, cut_b, size_a, size_b, doc)
        links = np.zeros(n, np.int64)
        np.add.at(links, doc, size_a * size_b)
        return {"n_a": ta, "n_b": tb, "n_groups": np.bincount(doc, minlength=n), "n_links": links,
                "sha": self._digests(ids_a, ids_b, cut_a, cut_b, size_a, size_b, ta + tb),
                "pairs": pairs, "held": held, "n_pairs": np.bincount(owner, minlength=n), "place": place, "times": times}

    def _digests(self, ids_a, ids_b, cut_a, cut_b, size_a, size_b, tokens):
        """SHA-256 of each document's groups as text: A ids, a bar, B ids; semicolons between groups."""
        cut_a, cut_b, size_a, size_b = (x.astype(np.int32) for x in (cut_a, cut_b, size_a, size_b))  # a block's tokens
        groups = np.arange(len(cut_a), dtype=np.int32)
        of_a, of_b = np.repeat(groups, size_a), np.repeat(groups, size_b)
        start_a, start_b = cut_a - size_a, cut_b - size_b
        at_a, at_b = np.arange(len(ids_a), dtype=np.int32), np.arange(len(ids_b), dtype=np.int32)
        order = np.empty(len(ids_a) + len(ids_b), np.int32)
        order[at_a + start_b[of_a]] = ids_a + self.n_a * (at_a != start_a[of_a])
        order[at_b + cut_a[of_b]] = 2 * self.n_a + ids_b + self.n_b * (at_b != start_b[of_b])
        del of_a, of_b, at_a, at_b
        text = self.marks[order].ravel()
        text = text[text != 0]
        upto = np.concatenate([[0], np.cumsum(self.mark_lengths[order], dtype=np.int64)])
        ends = np.cumsum(tokens)
        return [hashlib.sha256(text[upto[e - k] + 1:upto[e]]).hexdigest() if k else "" for e, k in zip(ends, tokens)]

    def _pairs(self, ids_a, ids_b, cut_a, cut_b, size_a, size_b, doc):
        """Distinct id pairs of the block and the documents that hold each; then, per document and
        distinct pair in the order of documents: its place among the block's pairs and its links."""
        keys, counts, room = [], [], self.n_a * self.n_b
        links = size_a * size_b
        upto, g = np.cumsum(links), 0
        while g < len(links):
            end = max(g + 1, int(np.searchsorted(upto, (upto[g - 1] if g else 0) + LINKS_AT_ONCE, side="right")))
            if end == g + 1:  # maybe a group of very many links: distinct ids first
                a, na = np.unique(ids_a[cut_a[g] - size_a[g]:cut_a[g]], return_counts=True)
                b, nb = np.unique(ids_b[cut_b[g] - size_b[g]:cut_b[g]], return_counts=True)
                keys.append((doc[g] * room + a[:, None].astype(np.int64) * self.n_b + b).ravel())
                counts.append((na[:, None] * nb).ravel())
            else:
                of = np.repeat(np.arange(g, end), links[g:end])
                i = np.arange(len(of)) - np.repeat(upto[g:end] - links[g:end] - (upto[g - 1] if g else 0), links[g:end])
                a = ids_a[(cut_a - size_a)[of] + i // size_b[of]].astype(np.int64)
                b = ids_b[(cut_b - size_b)[of] + i % size_b[of]]
                k, c = np.unique(doc[of] * room + a * self.n_b + b, return_counts=True)
                keys.append(k)
                counts.append(c)
            g = end
        keys = np.concatenate(keys or [np.zeros(0, np.int64)])
        counts = np.concatenate(counts or [np.zeros(0, np.int64)])
        keys, where = np.unique(keys, return_inverse=True)
        times = np.zeros(len(keys), np.int64)
        np.add.at(times, where, counts)
        pairs, place, held = np.unique(keys % room, return_inverse=True, return_counts=True)
        return pairs, held, keys // room, place, times


# -- Spark -----------------------------------------------------------------------------

_BLOCKS = ("block long, ids array<{id}>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
           "sha array<string>, pairs array<long>, held array<long>, n_pairs array<long>, place binary, times binary")


def _block_rows(vocabularies, schema, block_bytes):
    """Arrow batches of (id, text) become one row a block."""
    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        aligner = Aligner(byte_level(vocabularies.value[0]), sentence_pieces(vocabularies.value[1]))
        number = TaskContext.get().partitionId() << 32
        ids, texts, size = [], [], 0

        def row():
            out = aligner.block(texts)
            values = {"block": number, "ids": ids, **out, "place": out["place"].astype("<i4").tobytes(),
                      "times": out["times"].astype("<i4" if out["times"].max(initial=0) < 1 << 31 else "<i8").tobytes()}
            return pa.RecordBatch.from_arrays([pa.array([values[f.name]], f.type) for f in schema], schema=schema)

        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids.append(i)
                texts.append(t)
                size += len(t or "") + 16
                if size >= block_bytes:
                    yield row()
                    number, ids, texts, size = number + 1, [], [], 0
        if ids:
            yield row()
    return run


def _scores(schema):
    """One block and the corpus counts of its pairs become one row a document."""
    def run(block, counts):
        import pyarrow as pa

        if not block.num_rows:
            return pa.Table.from_arrays([pa.array([], f.type) for f in schema], schema=schema)
        b = {c: block.column(c)[0].as_py() for c in block.column_names if c != "held"}
        at = counts.column("at").to_numpy()
        count, best = np.zeros(len(at), np.int64), np.zeros(len(at), bool)
        count[at] = counts.column("count").to_numpy()
        best[at] = counts.column("best").to_numpy()
        place = np.frombuffer(b["place"], "<i4")
        times = np.frombuffer(b["times"], "<i4" if len(b["times"]) == 4 * len(place) else "<i8").astype(np.int64)
        upto = np.concatenate([[0], np.cumsum(np.array(b["n_pairs"], np.int64))])

        def per_document(values):
            sums = np.concatenate([[0], np.cumsum(values)])
            return sums[upto[1:]] - sums[upto[:-1]]
        out = {"doc_id": b["ids"], "n_a": b["n_a"], "n_b": b["n_b"], "n_groups": b["n_groups"], "n_links": b["n_links"],
               "n_best": per_document(times * best[place]), "count_sum": per_document(times * count[place]),
               "groups_sha256": b["sha"]}
        return pa.Table.from_arrays([pa.array(out[f.name], f.type) for f in schema], schema=schema)
    return run


def pair_counts(blocks: DataFrame, n_b: int) -> DataFrame:
    """(pair, count, best): in how many documents each id pair is linked, and whether that is its A id's highest."""
    from pyspark.sql import Window

    counts = stage(blocks.select(F.explode(F.arrays_zip("pairs", "held")).alias("p"))
                   .groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.held").alias("count")), "pair-counts")
    # An A id has as many rows as there are B ids at most.
    same_a = Window.partitionBy(F.floor(F.col("pair") / n_b))
    return counts.select("pair", "count", (F.col("count") == F.max("count").over(same_a)).alias("best"))


def aligned_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folder: str = FOLDER,
                      block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = docs.sparkSession
    files = []
    for name in VOCABULARIES:
        with open(os.path.join(folder, name), "rb") as f:
            files.append(f.read())
    # Two vocabulary files of fixed size; executors need no copy of the folder.
    vocabularies = spark.sparkContext.broadcast(tuple(files))
    n_b = len(sentence_pieces(files[1]).pieces)
    id_type = docs.schema[id_col].dataType.simpleString()
    layout = _BLOCKS.format(id=id_type)
    empty = spark.createDataFrame([], layout)
    blocks = stage(docs.select(id_col, text_col).mapInArrow(
        _block_rows(vocabularies, to_arrow_schema(empty.schema), block_bytes), layout), "aligned-blocks")
    counts = pair_counts(blocks, n_b)
    own = (blocks.select("block", F.posexplode("pairs").alias("at", "pair")).join(counts, "pair")
           .select(F.col("block").alias("to"), F.col("at").cast("long").alias("at"), "count", "best"))
    result = (f"doc_id {id_type}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
              "groups_sha256 string")
    kernel = _scores(to_arrow_schema(spark.createDataFrame([], result).schema))
    return (blocks.drop("pairs", "held").groupBy("block").cogroup(own.groupBy("to"))
            .applyInArrow(lambda left, right: kernel(left, right), result))
