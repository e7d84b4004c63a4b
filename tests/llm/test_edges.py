"""Every operator on nulls, empty and long texts, ties, repeated rows, empty tables and clashing extra columns."""

import pytest
from pyspark.sql import functions as F

LONG = "alpha beta gamma " * 3000
TEXTS = [(1, "one two three four five six", "a"), (2, None, "a"), (3, "", None), (4, LONG, "b"), (5, LONG, "b"),
         (5, LONG, "b"), (None, "orphan text here", "c"), (7, "   \t\n ", "c"), (8, "password = Abcdefghij1234567890", "a"),
         (9, "éé ßß \U0001F600 x", None), (9, "another text under the same id", "a")]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = ["size", "target", "fp", "hits", "score", "spans", "did", "word", "y", "h", "root", "copies", "found", "gone", "n", "c"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", s, None if t is None else len(t)) for i, t, s in TEXTS]
    df = spark.createDataFrame(rows, SCHEMA)
    return df.withColumns({c: F.lit(f"extra {c}") for c in CLASH})


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(1, 1, 0), (2, 1, 0), (4, 0, 1), (5, 1, 1), (8, 0, 0), (8, 1, 1), (None, 1, 1), (9, None, None), (7, 3, 3)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_suffix_array_dedup(docs, empty):
    from ledgerscope.llm.substrings import remove_repeats
    rows = remove_repeats(docs).collect()
    assert len(rows) == len(TEXTS)
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    assert by[2][0].n_bytes == 0 and by[3][0].n_removed == 0
    assert by[1][0].n_removed == 0
    period = len("alpha beta gamma ")
    assert by[4][0].n_removed == len(LONG) - period  # periodic: all but the first period starts earlier
    assert [r.n_removed for r in by[5]] == [len(LONG)] * 2  # equal rows are one document
    assert remove_repeats(empty).count() == 0


def test_suffix_array_dedup_orders_repeated_ids(spark):
    """A repeated id keeps its place: the passage stays in 5 and goes from 9 and from the null id."""
    from ledgerscope.llm.substrings import remove_repeats
    passage = " ".join(f"word{i}" for i in range(60))
    rows = [(5, "first " + passage), (5, "other text"), (9, "ninth " + passage), (None, "none " + passage), (11, "x")]
    got = {(r.doc_id, r.n_bytes): r.n_removed for r in remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    size = len(passage) + 1  # with the space before it
    assert got == {(5, 6 + size - 1): 0, (5, 10): 0, (9, 6 + size - 1): size, (None, 5 + size - 1): size, (11, 1): 0}


def test_page_text(spark):
    from ledgerscope.llm.html_diff import extract_main_text
    html = "<html><body><nav>Menu</nav><article><p>Body &amp; soul</p></article></body></html>"
    rows = [(1, "http://h/a", html), (2, None, None), (3, "http://h/b", ""), (3, "http://h/b", ""), (None, "x", "<p>plain"),
            (5, "http://h/c", "<p>" + "word " * 20000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string") \
        .withColumns({c: F.lit("x") for c in ("text", "host", "path", "at", "gone", "hashes")})
    got = {(r.page_id, r.url): r for r in extract_main_text(pages).collect()}
    assert got[(1, "http://h/a")].text == "Body & soul" and got[(2, None)].text == "" and got[(None, "x")].text == "plain"
    assert got[(5, "http://h/c")].n_chars == 20000 * 5 - 1
    assert extract_main_text(pages).count() == len(rows)
    assert extract_main_text(pages.limit(0)).count() == 0


def test_mix(docs, empty):
    from ledgerscope.llm.mixing import mix, training_order
    rows = mix(docs).collect()
    assert len(rows) == len(TEXTS) and all(0 <= r["taken"] <= 3 * r["size"] for r in rows)
    assert {r["lang"] for r in rows} == {"en"} and rows[0]["hits"] == "extra hits"
    again = mix(docs).collect()
    assert sorted(map(repr, rows)) == sorted(map(repr, again))
    order = [r.position for r in training_order(docs).collect()]
    assert order == sorted(order) and mix(empty).count() == 0


def test_embeddings(spark):
    from ledgerscope.llm.cover_tree import embedding_groups
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]),
            (8, []), (9, [0.0, 1.0]), (9, [0.0, 1.0]), (None, [0.0, 3.0]), (11, [1.0, 0.01, 0.0]), (12, [1e38, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>") \
        .withColumns({c: F.lit("x") for c in ("gid", "n", "home", "root", "label")})
    got = [(r.vec_id, r.n_links, r.component_id, r.kept) for r in embedding_groups(df).collect()]
    want = [(1, 3, 1, True), (2, 3, 1, False), (11, 3, 1, False), (12, 3, 1, False), (9, 2, 9, True), (9, 2, 9, True),
            (None, 2, 9, False)] + [(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8)]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert embedding_groups(df.limit(0)).count() == 0
    assert embedding_groups(df.filter("vec_id = 3")).count() == 1


def test_pitman_yor(docs, empty):
    from ledgerscope.llm.pitman_yor import score_documents
    held = F.coalesce(F.col("doc_id"), F.lit(0)) % 2 == 0
    rows = score_documents(docs, held, symbols=4, dictionary=8).collect()
    assert len(rows) == len(TEXTS) and all(r.score < 0 and r.base_score < 0 for r in rows)
    assert {r.n_tokens for r in rows if r.doc_id in (2, 3, 7)} == {1}
    assert score_documents(empty, held).count() == 0
    nothing = score_documents(docs, F.lit(True), symbols=4).collect()  # no training documents
    assert {r.train_tokens for r in nothing} == {0} and all(r.n_known == 0 for r in nothing)


def test_decontaminate(spark, docs, empty):
    from ledgerscope.llm.decontaminate import decontaminate, with_hits
    bench = spark.createDataFrame([(1, "three four"), (1, "three four"), (None, "orphan"), (3, None), (4, ""), (5, "ÉÉ ßß")],
                                  "item_id long, text string").withColumn("hits", F.lit(1))
    got = {r.doc_id: r.hits for r in with_hits(docs.drop("hits"), bench).collect()}
    assert (got[1]["n_hit"], got[1]["items"]) == (2, ["1"]) and got[None]["items"] == [""]
    assert got[2]["n_words"] == 0 and got[7]["n_hit"] == 0
    kept = decontaminate(docs, bench)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {2, 3, 4, 5, 7, 8, 9}
    assert with_hits(empty, bench).count() == 0
    assert decontaminate(docs, bench.limit(0)).count() == len(TEXTS)


@pytest.mark.parametrize("which", ["toxic", "quality"])
def test_classifiers(docs, empty, labels, which):
    if which == "toxic":
        from ledgerscope.llm.toxicity import drop_toxic, toxicity_scores
        run = lambda d, l: toxicity_scores(d.drop("score"), docs, l)
        assert drop_toxic(docs, docs, labels).columns == docs.columns
    else:
        from ledgerscope.llm.quality import quality_scores
        run = lambda d, l: quality_scores(d.drop("score"), l)
    rows = run(docs, labels).collect()
    assert len(rows) == len(TEXTS) and all(0 <= r.score <= 1 for r in rows)
    assert len({round(r.score, 9) for r in rows if r.doc_id in (2, 3)}) == 1  # null and empty alike
    assert run(empty, labels).count() == 0
    assert run(docs, labels.limit(0)).count() == len(TEXTS)


def test_simhash(docs, empty):
    from ledgerscope.llm.simhash import keep_one, simhash_groups
    got = [(r.doc_id, r.component_id) for r in simhash_groups(docs).collect()]
    assert len(got) == len(TEXTS) and {(2, 2), (3, 2), (7, 2), (4, 4), (5, 4)} <= set(got)
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(4) == 1 and 5 not in ids and 3 not in ids and ids.count(None) == 1
    assert simhash_groups(empty).count() == 0 and keep_one(empty).count() == 0


def test_secrets(docs, empty):
    from ledgerscope.llm.secrets import redact, scan_secrets
    got = {r.doc_id: r.spans for r in scan_secrets(docs).collect()}
    assert [(s["start"], s["end"], s["rank"]) for s in got[8]] == [(0, 31, 0)]
    assert got[2] == [] and got[3] == [] and got[4] == []
    clean = {(r.doc_id, r.text, r.n_chars) for r in redact(docs).collect()}
    assert (8, "[SECRET]", 8) in clean and (1, TEXTS[0][1], len(TEXTS[0][1])) in clean and (2, None, None) in clean
    assert redact(docs).columns == docs.columns and redact(docs).count() == len(TEXTS)
    assert scan_secrets(empty).count() == 0 and redact(empty).count() == 0


def test_secrets_of_one_owner_in_many_documents(spark):
    """A value that many documents of one source hold is a copied example; repeated rows are one document."""
    from ledgerscope.llm.secrets import redact, scan_secrets
    copied, own = "Zx9Qw8Er7Ty6Ui5Op4As3", "Mn1Bv2Cx3Za4Sd5Fg6Hj7"
    rows = [(i, f"page {i} password = {copied} and {copied}Q", "hot") for i in range(40)] + [(99, f"token: {own}", "hot")] * 5
    df = spark.createDataFrame([(i, t, s, len(t)) for i, t, s in rows], "doc_id long, text string, source string, n_chars long")
    got = scan_secrets(df).collect()
    assert len(got) == 45
    assert all([(s["rank"], s["live"]) for s in r.spans] == [(0, r.doc_id == 99)] for r in got)
    texts = {r.doc_id: r.text for r in redact(df).collect()}
    assert texts[99] == "[SECRET]" and texts[3] == f"page 3 [EXAMPLE_SECRET] and {copied}Q"


def test_secret_verdict_in_sql_counts_documents(spark):
    """Owners and documents differ here: the SQL must follow both."""
    import duckdb
    from ledgerscope.llm.oracles import ORACLES
    from ledgerscope.llm.secrets import scan_secrets
    copied, own = "Zx9Qw8Er7Ty6Ui5Op4As3", "Mn1Bv2Cx3Za4Sd5Fg6Hj7"
    rows = [(i, f"see {copied} here {i}", "hot") for i in range(5)] + [(9, f"key {own}", "hot"), (9, f"key {own}", "hot"), (10, own, "hot")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    documents = df.toPandas()  # noqa: F841 - read by name
    sql = sorted((r[0], r[5]) for r in duckdb.sql(ORACLES["op10_ownership_secrets"]).fetchall())
    from ledgerscope.llm.secrets import listed
    got = sorted((r.doc_id, r.spans) for r in scan_secrets(df).select("doc_id", listed(F.col("spans")).alias("spans")).collect())
    assert got == sql and {s for i, s in got if i < 5} == {""} and all(s.startswith("live:") for i, s in got if i >= 9)


def test_keep_one_with_one_id_first_of_two_components(spark):
    from ledgerscope.llm.simhash import keep_one
    a, b, c = ("red green blue yellow " * 9, "one two three four five " * 9, "north south east west " * 9)
    rows = [(1, a), (1, a), (1, b), (1, b), (2, c), (3, c), (3, a)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(tuple(r) for r in keep_one(df).collect()) == sorted([(1, a), (1, b), (2, c)])


def test_planted_links_near_the_threshold(spark):
    """Pairs just above and below cosine 0.95, with and without several leaves; each linked pair counts on both sides."""
    import numpy as np
    from ledgerscope.llm.cover_tree import embedding_groups
    rng, rows, want = np.random.default_rng(11), [], {}
    for k in range(60):
        u = rng.normal(size=32)
        u /= np.linalg.norm(u)
        w = rng.normal(size=32)
        w -= (w @ u) * u
        w /= np.linalg.norm(w)
        for j, cos in enumerate((1.0, 0.95 + 2e-6, 0.95 - 2e-6, 0.5)):
            rows.append((4 * k + j, [float(x) for x in cos * u + np.sqrt(1 - cos * cos) * w]))
    x = np.array([r[1] for r in rows])
    x /= np.linalg.norm(x, axis=1)[:, None]
    links = (x @ x.T >= 0.95) & ~np.eye(len(x), dtype=bool)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    for leaf_rows in (4096, 20):
        got = {r.vec_id: r for r in embedding_groups(df, leaf_rows=leaf_rows).collect()}
        assert [got[i].n_links for i in range(len(rows))] == links.sum(axis=1).tolist()
        assert all(got[4 * k + 1].component_id == 4 * k and got[4 * k].n_links >= 1 for k in range(60))
