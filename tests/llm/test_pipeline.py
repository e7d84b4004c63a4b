"""The pipeline's stages take effect and keep the columns of documents."""

import duckdb
import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    import corpus_pipeline as cp
    from ledgerscope.llm.common import stage, table
    docs, out = table(spark, SF, "documents"), []
    for name, step in cp.STAGES:
        nxt = stage(step(spark, docs, SF), name)
        out.append((name, docs, nxt))
        docs = nxt
    return out


def test_order_and_columns(stages):
    assert [n for n, *_ in stages] == ["toxicity", "simhash_near_dedup", "decontamination", "secret_scan", "mixing"]
    for _, before, after in stages[:-1]:
        assert after.columns == before.columns and after.count() <= before.count()


def test_decisions_take_effect(spark, stages):
    by = {n: (b, a) for n, b, a in stages}
    from ledgerscope.llm.decontaminate import is_contaminated, with_hits
    from ledgerscope.llm.secrets import scan_secrets
    from ledgerscope.llm.simhash import simhash_groups
    from pyspark.sql import functions as F

    before, after = by["simhash_near_dedup"]
    want = {r.component_id for r in simhash_groups(before).collect()}
    assert sorted(r.doc_id for r in after.select("doc_id").collect()) == sorted(want)
    before, after = by["decontamination"]
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    bad = {r.doc_id for r in with_hits(before, bench).filter(is_contaminated(F.col("hits"))).collect()}
    assert bad and {r.doc_id for r in before.collect()} - {r.doc_id for r in after.collect()} == bad
    before, after = by["secret_scan"]
    assert before.count() == after.count()
    assert not any(s["rank"] < 3 for r in scan_secrets(after).collect() for s in r.spans)
    _, mixed = by["mixing"]
    rows = mixed.collect()
    assert [r.position for r in rows] == sorted(r.position for r in rows)
    assert all(0 < r.taken <= 3 * r["size"] for r in rows)
    for src in {r.source for r in rows}:
        own = [r for r in rows if r.source == src]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 1


def test_run_equals_stages(spark, stages):
    import corpus_pipeline as cp
    a = sorted((r.doc_id, r.taken, r.position) for r in cp.run(spark, SF).collect())
    b = sorted((r.doc_id, r.taken, r.position) for r in stages[-1][2].collect())
    assert a == b


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001"])
def test_oracles(spark, sf):
    """SQL oracles in DuckDB over the same tables."""
    import os

    from ledgerscope.llm.oracles import ORACLES
    from ledgerscope.llm.queries import QUERIES
    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark"):
        if os.path.exists(f"{sf}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")

    def norm(cols, rows):
        order = sorted(range(len(cols)), key=cols.__getitem__)
        return sorted(repr([round(r[i], 5) if isinstance(r[i], float) else r[i] for i in order]) for r in rows)
    for name, sql in ORACLES.items():
        df = QUERIES[name](spark, sf)
        got = con.execute(sql)
        cols = [d[0] for d in got.description]
        assert sorted(cols) == sorted(df.columns)
        assert norm(df.columns, [tuple(r) for r in df.collect()]) == norm(cols, got.fetchall()), name
