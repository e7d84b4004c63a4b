"""Operators without SQL against brute force, exact round trips or held-out accuracy."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

SF = "/root/testdata/sf0.001"
SF_LABELS = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=60))
def test_suffix_array(text):
    from ledgerscope.llm.gsaca import suffix_array
    assert suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


def _removed(docs, length):
    seen, out = set(), {}
    for i, b in sorted(docs.items()):
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            w = b[p:p + length]
            if w in seen:
                gone[p:p + length] = b"\1" * length
            seen.add(w)
        out[i] = bytes(gone)
    return out


def test_suffix_array_dedup(spark, texts):
    from ledgerscope.llm.queries import QUERIES
    docs = {i: (t or "").encode() for i, t in texts.items()}
    want = _removed(docs, 100)
    for r in QUERIES["op1_suffix_array_dedup"](spark, SF).collect():
        b, gone = docs[r.doc_id], want[r.doc_id]
        kept = bytes(c for c, g in zip(b, gone) if not g)
        assert (r.n_bytes, r.n_removed, r.n_spans) == (len(b), sum(gone), len(re.findall(b"\1+", gone)))
        assert r.kept_sha256 == hashlib.sha256(kept).hexdigest()


def test_suffix_array_dedup_without_word_ends(spark):
    """Edited copies of texts without white space are sorted by bytes; texts with it by words."""
    from ledgerscope.llm.substrings import remove_repeats
    rng = random.Random(5)
    docs = {}
    for k in range(12):
        base = "".join(rng.choice("abcd" if k % 2 else "ab cd ef") for _ in range(900))
        for j in range(5):
            t = list(base)
            for _ in range(j):
                t[rng.randrange(len(t))] = "X"
            docs[len(docs)] = "".join(t)
    docs[len(docs)] = "z" * 700
    want = _removed({i: t.encode() for i, t in docs.items()}, 100)
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(5)
    for r in remove_repeats(df, keep_text=True).collect():
        kept = bytes(c for c, g in zip(docs[r.doc_id].encode(), want[r.doc_id]) if not g)
        assert (bytes(r.kept), r.n_removed) == (kept, sum(want[r.doc_id]))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=14), st.lists(st.integers(0, 4), max_size=14))
def test_alignment_is_a_longest_common_subsequence(a, b):
    from ledgerscope.llm.html_diff import aligned
    best = {}
    for i, j in itertools.product(range(len(a) + 1), range(len(b) + 1)):
        best[i, j] = 0 if not i or not j else max(best[i - 1, j], best[i, j - 1], best[i - 1, j - 1] + (a[i - 1] == b[j - 1]))
    got = aligned(a, b)
    rest = iter(b)
    assert len(got) == best[len(a), len(b)] and got == sorted(got) and all(any(x == y for y in rest) for x in (a[i] for i in got))


def test_page_differencing_removes_the_template(spark):
    from ledgerscope.llm.html_diff import extract_main_text
    page = ("<html><body><div class='x1'>Home | News | About us</div><div>{0} first line.</div><div>{0} second &mdash; line."
            "</div><div>Call us today</div><div class='comments'><p>I like {0}</p></div><form>Send</form></body></html>")
    rows = [(i, f"https://h.example/{p}", page.format(p)) for i, p in enumerate(("a/one", "a/two", "b/three"))]
    rows.append((9, "https://h.example/a/one?copy=1", page.format("a/one")))
    got = {r.page_id: r.text for r in extract_main_text(
        spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[1] == "a/two first line. a/two second — line." and got[2] == "b/three first line. b/three second — line."


def test_page_differencing_tells_templates_from_copies(spark):
    """A template of 80 % of the text goes; a copy, exact or edited in one line, deletes nothing of its own accord."""
    from ledgerscope.llm.html_diff import extract_main_text
    frame = "".join(f"<div>Template line {k:02d} of the shop, the same on every page of it.</div>" for k in range(12))
    own = "".join(f"<div>{{0}} tells what only page {{0}} tells, part {k} of the page.</div>" for k in range(3))
    rows = [(i, f"https://shop.example/{p}", frame + own.format(p)) for i, p in enumerate(("a/one", "a/two", "b/three", "b/four"))]
    story = [f"<div>Sentence {k:02d} of a long story that two addresses hold.</div>" for k in range(30)]
    rows += [(10, "https://news.example/x/1", "".join(story)), (11, "https://news.example/x/1?print", "".join(story)),
             (12, "https://news.example/x/2", "".join([*story[:29], "<div>Sentence 29 was edited later.</div>"]))]
    two = [(20 + i, f"https://two.example/{p}", frame + own.format(p)) for i, p in enumerate(("one", "two"))]
    got = {r.page_id: r.text for r in extract_main_text(
        spark.createDataFrame(rows + two, "page_id long, url string, html string")).collect()}
    for i, url, page in [*rows[:4], *two]:
        p = url.split("example/")[1]
        assert 0.75 < len(frame) / len(page) < 0.85
        assert got[i] == " ".join(f"{p} tells what only page {p} tells, part {k} of the page." for k in range(3))
    assert all(got[i].startswith("Sentence 00 of") and got[i].count("Sentence") == 30 for i in (10, 11, 12))


@pytest.mark.parametrize("page, text", [
    ("<main><h1>T</h1><p>Main text</p><article class='card'>Teaser</article></main>", "T Main text"),
    ("<main><h1>T</h1><article><p>The long article text</p></article></main>", "The long article text"),
    ("<article><p class='share-price'>Up</p><p class='form-of-address'>Sir</p><div class='related-work'>Others did</div>"
     "<label>Name</label><div class='related-posts'>More</div><div class='post-comments'><p>Hi</p></div></article>", "Up Sir Others did Name"),
    ("<body><nav><a>Home</a><ul><li>News</li></ul><h1>Title</h1><p>Body</p></body>", "Title Body"),
    ("<body><NAV><p>Home</p></NAV><div class='site-footer'>Foot</div><div class='ad-300x250'>Buy</div><p>Body</p></body>", "Body"),
    ("<body><div class='cookie-banner'>We use</div><form><label>Mail</label></form><p>Body</p></body>", "Body")])
def test_page_furniture(page, text):
    from ledgerscope.llm.html_diff import blocks
    assert " ".join(t for t, _, _ in blocks(page)) == text


def test_pages_keep_the_whole_article(spark):
    import html
    from ledgerscope.llm.queries import QUERIES
    raw = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in QUERIES["op2_nearest_url_text"](spark, SF).collect():
        body = raw[r.page_id].split("<article>", 1)[1].split("</article>", 1)[0]
        assert r.text == " ".join(html.unescape(re.sub(r"</?(?:p|h1|br)>", "\n", re.sub(r"</?b>", "", body))).split())
        assert r.n_chars == len(r.text)


def test_cover_tree_over_many_leaves_and_chunks(spark):
    import numpy as np
    from ledgerscope.llm.cover_tree import embedding_groups
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 5))
    x = np.concatenate([c + rng.normal(scale=s, size=(k, 5)) for c, s, k in zip(centres, (.05, .2, .4, .02, 1, .3), (80, 60, 90, 50, 120, 40))])
    x = x.astype(np.float32)
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1)[:, None]
    hit = u @ u.T >= 0.95
    np.fill_diagonal(hit, False)
    root = list(range(len(x)))
    for i, j in zip(*np.nonzero(hit)):
        a, b = i, j
        while root[a] != a:
            a = root[a]
        while root[b] != b:
            b = root[b]
        root[max(a, b)] = min(a, b)

    def top(i):
        while root[i] != i:
            i = root[i]
        return i
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    for r in embedding_groups(df, leaf_rows=16, max_pivots=9).collect():
        assert (r.n_links, r.component_id) == (int(hit[r.vec_id].sum()), top(r.vec_id))


def test_pitman_yor_base_and_gain(spark, texts):
    from ledgerscope.llm.queries import QUERIES
    toks = {i: (t or "").encode().lower().split() + [b""] for i, t in texts.items()}
    train = Counter(w for i, t in toks.items() if zlib.crc32(str(i).encode()) % 10 for w in t)
    n, v = sum(train.values()), len(train)
    rows = QUERIES["op5_pitman_yor_scores"](spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = sum(math.log10((train[w] + 0.1) / (n + 0.1 * (v + 1))) for w in toks[r.doc_id])
        assert math.isclose(r.base_score, base, rel_tol=1e-9)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(toks[r.doc_id]), sum(train[w] > 0 for w in toks[r.doc_id]), n)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 10 == 0)
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_pitman_yor_is_a_distribution(spark):
    """Probabilities of all words (known ones and one unknown per length) add up to one in every context."""
    from ledgerscope.llm.pitman_yor import fit_contexts
    import numpy as np
    rng = random.Random(1)
    cells = [(c, s, rng.choice([1, 1, 2, 9, 400, 20000])) for c in range(7) for s in range(6) if rng.random() < .7]
    logp = fit_contexts(spark.createDataFrame(cells, "ctx long, sym long, n long"), 6)
    assert np.allclose((10 ** logp).sum(axis=1), 1)


def test_pitman_yor_learns_bigrams_of_rare_words(spark):
    """Rare words are contexts of their own: a pair that always follows beats the same words in the other order."""
    from pyspark.sql import functions as F
    from ledgerscope.llm.pitman_yor import score_documents
    rng = random.Random(4)
    vocab = [f"w{k:03d}" for k in range(120)]
    pairs = [(vocab[2 * k], vocab[2 * k + 1]) for k in range(60)]
    rows = [(i, " ".join(f"the of {a} {b}" for a, b in rng.choices(pairs, k=20))) for i in range(60)]
    rows += [(90_000 + k, f"{a} {b}") for k, (a, b) in enumerate(pairs)] + [(91_000 + k, f"{b} {a}") for k, (a, b) in enumerate(pairs)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: r.score for r in score_documents(df, F.col("doc_id") >= 10_000, symbols=3, dictionary=40).collect()}
    gain = [got[90_000 + k] - got[91_000 + k] for k in range(60)]
    assert sum(g > 1 for g in gain) >= 57


def test_pitman_yor_sweeps_keep_one_table(spark, tmp_path, monkeypatch):
    """A sweep over the class words removes the table of the sweep before it."""
    from ledgerscope.llm import common
    from ledgerscope.llm.pitman_yor import Lexicon, fit_class_words
    monkeypatch.setattr(common, "checkpoint_dir", lambda spark: str(tmp_path))
    lex = Lexicon([b"the", b"cat", b"dog", b"bird"], np.array([9.0, 4.0, 3.0, 2.0]), 1)
    words, cls = fit_class_words(spark.createDataFrame([(1, 4), (2, 3), (3, 2)], "w long, c long"), common.Shipped(spark, lex), 5, 2, 1.0, 7)
    assert len(list(tmp_path.glob("class-words-*"))) == 1
    assert sorted(r.w for r in words.collect()) == [1, 2, 3] and cls["c"].sum() == 9


def test_seating_has_the_right_mean():
    """Mean tables of a Pitman-Yor restaurant of one dish under a certain parent: the number of classes in closed form."""
    from ledgerscope.llm.pitman_yor import seat
    rng, d, th, n = np.random.default_rng(0), 0.5, 1.0, 500
    got = np.mean([seat(np.array([n]), np.ones(1), np.zeros(1), d, th, rng)[0] for _ in range(400)])
    want = th / d * (math.exp(math.lgamma(th + d + n) + math.lgamma(th) - math.lgamma(th + n) - math.lgamma(th + d)) - 1)
    # The parent's mass one makes every customer choose between all tables and a new one.
    assert abs(got - want) < 0.05 * want


def _law(n, p, d, others, strength=1.0, most=None):
    """The exact law of a dish's tables: Chinese restaurant weights of all seatings, summed step by step."""
    most = most or n
    t = np.arange(1, most + 1)
    w = np.zeros(most)
    w[0] = 1.0
    for i in range(1, n):
        new = (i - d * t) * w
        new[1:] += w[:-1] * p * (strength + d * (others + t[:-1]))
        w = new / new.sum()
    return w


@pytest.mark.parametrize("n, p, d, others", [
    (5, .3, .5, 0), (3, 1.0, .7, 0), (50, .01, .5, 20), (200, .001, .8, 200), (10, 1e-4, .9, 500), (128, .6, .4, 30), (900, .02, .6, 40),
    (3000, .3, .75, 400), (700, .9, .1, 10), (2500, 1e-6, .8, 90), (4000, .5, .9, 2000)])
def test_seating_follows_the_exact_conditional(n, p, d, others):
    from ledgerscope.llm.pitman_yor import seat
    size = 20_000
    got = seat(np.full(size, n), np.full(size, p), np.full(size, float(others)), d, 1.0, np.random.default_rng(4))
    w, t = _law(n, p, d, others, most=min(n, 3000)), np.arange(1, min(n, 3000) + 1)
    mean = (w * t).sum()
    sd = math.sqrt((w * t * t).sum() - mean ** 2)
    assert abs(got.mean() - mean) < 5 * sd / math.sqrt(size) + (0.02 * sd + 1 if mean > 60 else 1e-3 * mean), (got.mean(), mean, sd)
    assert abs(got.std() - sd) < 0.05 * sd + 0.01
    if mean < 40:
        share = np.bincount(got.astype(int), minlength=n + 1)[1:len(w) + 1] / size
        assert np.abs(share.cumsum() - w.cumsum()).max() < 0.02


def test_wu_manber_blocks_agree(spark, texts):
    from ledgerscope.llm.decontaminate import with_hits, words_of
    docs, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    one = {r.doc_id: r.hits for r in with_hits(docs, bench).collect()}
    many = {r.doc_id: r.hits for r in with_hits(docs, bench, block_words=1500).collect()}
    assert one == many
    items = [(str(r.item_id), words_of(r.text)) for r in bench.collect()]
    for i, t in texts.items():
        w, hit, ids = words_of(t), set(), set()
        for k, p in items:
            m = min(13, len(p))
            wins = {tuple(p[a:a + m]) for a in range(len(p) - m + 1)} if m else set()
            for a in range(len(w) - m + 1 if wins else 0):
                if tuple(w[a:a + m]) in wins:
                    hit |= set(range(a, a + m))
                    ids.add(k)
        assert (one[i]["n_hit"], sorted(ids)) == (len(hit), list(one[i]["items"]))


@pytest.mark.parametrize("query,label", [("op7_kneser_ney_toxicity", "toxic"), ("op9_positive_unlabelled_quality", "quality")])
def test_held_out_accuracy(spark, query, label):
    from ledgerscope.llm.queries import QUERIES
    labels = spark.read.parquet(f"{SF_LABELS}/labels.parquet").select("doc_id", label)
    rows = QUERIES[query](spark, SF_LABELS).join(labels, "doc_id").filter("held_out").collect()
    right = sum(r.predicted == r[label] for r in rows)
    assert len(rows) > 50 and right / len(rows) >= 0.93
    assert all(r.predicted == int(r.score >= (0.7 if label == "toxic" else 0.5)) for r in rows)
    clean = [r for r in rows if r[label] == (label == "quality")]
    assert sum(r.predicted == (label == "quality") for r in clean) / len(clean) >= 0.97


def test_simhash_against_all_pairs(spark, texts):
    import xxhash
    from ledgerscope.llm.queries import QUERIES

    def fp(t):
        w = (t or "").encode().lower().split()
        sh = [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) > 2 else [b" ".join(w)] if w else []
        h = [xxhash.xxh64_intdigest(s, 42) for s in sh]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
    fps = {i: fp(t) for i, t in texts.items()}
    comp = {i: i for i in fps}
    changed = True
    while changed:
        changed = False
        for a, b in itertools.combinations(fps, 2):
            if comp[a] != comp[b] and (fps[a] ^ fps[b]).bit_count() <= 2:
                comp[a] = comp[b] = min(comp[a], comp[b])
                changed = True
    for r in QUERIES["op8_covering_simhash"](spark, SF).collect():
        assert (int(r.fingerprint, 16), r.component_id) == (fps[r.doc_id], comp[r.doc_id])


def test_covering_masks_lose_no_pair():
    from ledgerscope.llm.simhash import covering_masks
    for radius in (1, 2, 3):
        masks = covering_masks(radius)
        rng = random.Random(radius)
        for bits in itertools.chain(itertools.combinations(range(64), min(radius, 2)),
                                    (rng.sample(range(64), radius) for _ in range(2000))):
            flip = sum(1 << b for b in bits)
            assert any(not flip & m for m in masks)


def test_simhash_hot_buckets(spark):
    """Buckets above the limit are re-keyed on parts of the open bits and still lose no link."""
    from ledgerscope.llm.simhash import link_components
    rng = random.Random(9)
    centre = rng.getrandbits(63)
    fps = {centre}
    for _ in range(400):
        fps.add(rng.choice(sorted(fps)) ^ (1 << rng.randrange(63)) ^ (1 << rng.randrange(63)))
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    small = {(r.fp, r.root) for r in link_components(df, 2).collect()}
    hot = {(r.fp, r.root) for r in link_components(df, 2, hot_bucket=5).collect()}
    assert small == hot and {r for _, r in small} == {min(fps)} and {f for f, _ in small} == fps


def test_toxicity_fit_keeps_few_objects_on_the_driver(spark):
    """The sample's words are ids there: 1.2 million words as objects took 97 MB, as ids 31."""
    import tracemalloc

    from pyspark.sql import functions as F

    from ledgerscope.llm.toxicity import toxicity_scores
    docs = spark.range(3600).select(F.col("id").alias("doc_id"), F.expr(
        "concat_ws(' ', transform(sequence(1, 500), i -> concat('word', pmod(xxhash64(id, i), 4000))))").alias("text"))
    labels = spark.range(3600).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("toxic"))
    tracemalloc.start()
    try:
        scores = toxicity_scores(docs, docs, labels)
        peak = tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()
    assert peak < 50, peak
    assert scores.filter("score between 0 and 1").count() == 3600


def test_toxicity_model_ignores_words_of_other_texts():
    """A model of some texts of a vocabulary equals the one with a vocabulary of its own."""
    from ledgerscope.llm.toxicity import KneserNey, learn
    rng = random.Random(3)
    texts = [" ".join(rng.choices("abcdefghij", k=rng.randrange(30))) for _ in range(60)] + [None, ""]
    y = np.arange(62) % 2
    wide, own = {}, {}
    for word in "xyzj":
        learn(word, wide)
    a = KneserNey(wide, [learn(t, wide) for t in texts], y)
    b = KneserNey(own, [learn(t, own) for t in texts], y)
    words = [b"a", b"j", b"x", b"never", b"c"]
    assert (a.ratio([a.ids(words), a.ids([])]) == b.ratio([b.ids(words), b.ids([])])).all()
    assert (a.diff[[a.vocab[w] for w in b.vocab]] == b.diff[[b.vocab[w] for w in b.vocab]]).all()
    assert a.diff[a.vocab[b"x"]] == 0.0 and np.abs(b.diff).max() > 0
