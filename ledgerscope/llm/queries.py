"""The registered queries of the subpackage: each applies one operator, with
production parameters, to its whole table and returns the contract's columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerscope.llm.common import table
from ledgerscope.llm.oracles import ORACLES  # noqa: F401
from ledgerscope.session import configure


def _held_out(mod: int, rest: int):
    return (F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % mod) == rest


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerscope.llm.substrings import remove_repeats
    return remove_repeats(table(spark, sf_dir, "documents"))


def op2_nearest_url_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerscope.llm.html_diff import extract_main_text
    return extract_main_text(table(spark, sf_dir, "pages"))


def op3_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerscope.llm.mixing import mix
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    mixed = mix(docs)
    return mixed.select("doc_id", "size", "source_size", "target", "taken",
                        F.get("copies", F.lit(0))["position"].alias("position")).orderBy("position", "doc_id")


def op4_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerscope.llm.cover_tree import embedding_groups
    return embedding_groups(table(spark, sf_dir, "embeddings"))


def op5_pitman_yor_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerscope.llm.pitman_yor import score_documents
    return score_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), _held_out(10, 0))


def op6_wu_manber(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerscope.llm.decontaminate import is_contaminated, with_hits
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    hits = with_hits(docs, table(spark, sf_dir, "benchmark"))
    h = F.col("hits")
    return hits.select("doc_id", h["n_words"].alias("n_words"), h["n_hit"].alias("n_hit"),
                       F.size(h["items"]).cast("long").alias("n_items"),
                       F.sha2(F.array_join(F.array_sort(h["items"]), ","), 256).alias("items_sha256"),
                       is_contaminated(h).alias("contaminated"))


def op7_kneser_ney_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerscope.llm.toxicity import THRESHOLD, toxicity_scores
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity_scores(docs, docs, table(spark, sf_dir, "labels"))
    return scored.select("doc_id", _held_out(3, 1).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def op8_covering_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerscope.llm.simhash import simhash_groups
    groups = simhash_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_positive_unlabelled_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerscope.llm.quality import THRESHOLD, quality_scores
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality_scores(docs, table(spark, sf_dir, "labels"))
    return scored.select("doc_id", _held_out(3, 1).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def op10_ownership_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerscope.llm.secrets import KINDS, listed, scan_secrets
    found = scan_secrets(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["rank"] < KINDS.index("live"))
    n = lambda r: F.size(F.filter("spans", lambda s: s["rank"] == r)).cast("long")
    return found.select("doc_id", n(0).alias("n_assign"), n(1).alias("n_access"), n(2).alias("n_hex"),
                        F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"),
                        F.size(F.filter("spans", lambda s: ~s["live"])).cast("long").alias("n_example"))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerscope.llm.line_dedup import deduplicated_lines
    return deduplicated_lines(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerscope.llm.token_align import aligned_documents
    return aligned_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerscope.llm.merkle import audited
    tampered = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3) == 0
    return audited(table(spark, sf_dir, "documents"), tampered).select(
        "doc_id", "leaf", "subroot", "root", F.sha2("proof", 256).alias("proof_sha256"), "folded_root", "verified")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


def _configured(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(configure(spark), sf_dir)
    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    return run


QUERIES = {f.__name__: _configured(f) for f in (
    op1_suffix_array_dedup, op2_nearest_url_text, op3_curriculum_mix, op4_cover_tree, op5_pitman_yor_scores, op6_wu_manber,
    op7_kneser_ney_toxicity, op8_covering_simhash, op9_positive_unlabelled_quality, op10_ownership_secrets,
    op11_line_dedup, op12_token_alignment, op13_merkle_manifest, pipeline)}
