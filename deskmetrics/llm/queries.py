"""Registered queries of the subpackage: ``(spark, sf_dir) -> DataFrame`` over
whole tables, with production parameters, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import prepare
from . import decontaminate, hmm, html_wrapper, jaccard_join, line_dedup, mixing, pairwise_rank, periodic_runs, \
    personal_data, quality_rules, secrets, sql, token_frames, whitening
from .common import held_out, scratch, table

Query = Callable[[SparkSession, str], DataFrame]


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(prepare(spark), sf_dir, "documents")


def op1_hidden_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.train_and_score(_documents(spark, sf_dir))


def domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, domain) of the labelled documents."""
    return table(spark, sf_dir, "labels").select(
        "doc_id", mixing.domain_of(F.col("quality"), F.col("toxic")).alias("domain"))


def op2_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "source", "text")
    return mixing.document_rates(docs, domains(spark, sf_dir)).drop("posterior") \
        .withColumn("copies", mixing.copies(F.col("rate"), F.col("doc_id")))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(_documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items",
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


def op4_pairwise_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").filter(held_out("doc_id", 5) != 0)
    ranking = pairwise_rank.learn(docs, labels)
    return pairwise_rank.score(docs, ranking).select(
        "doc_id", (held_out("doc_id", 5) == 0).alias("held_out"), "score",
        (F.col("score") >= pairwise_rank.THRESHOLD).cast("int").alias("predicted"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(_documents(spark, sf_dir).select("doc_id", "text"))
    count = lambda kind: F.size(secrets.of_kinds(F.col("spans"), (kind,))).cast("long")
    return found.select(
        "doc_id", *[count(kind).alias(f"n_{kind}") for kind in secrets.KINDS],
        F.sha2(secrets.listed(secrets.of_kinds(F.col("spans"), secrets.BASE_KINDS)).cast("binary"), 256)
        .alias("base_sha256"),
        secrets.listed(F.col("spans")).alias("spans"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(_documents(spark, sf_dir), shingle=3, num=9, den=10)


def byte_bpe() -> str:
    """The byte-level vocabulary's file among the public tokenizers."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def op7_token_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = token_frames.write_frames(_documents(spark, sf_dir), scratch(spark, "tokens"), byte_bpe())
    return token_frames.read_frames(files)


def op8_html_wrapper(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(prepare(spark), sf_dir, "pages")
    return html_wrapper.main_text(pages).withColumn("n_chars", F.length("text").cast("long"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    return quality_rules.judge(docs).drop("text", "clean_text")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.by_document(_documents(spark, sf_dir)).select(
        "doc_id", "n_lines", "n_removed", F.array_join("removed", ",").alias("removed"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(prepare(spark), sf_dir, "embeddings").select("vec_id", "embedding")
    white = whitening.whiten(rows, whitening.fit(rows))
    one = F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "own")
    return white.select("vec_id", "n", F.expr("try_cast(deviation AS bigint)").alias("deviation"), "identity_error",
                        one).select(
        "vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", F.col("own.whitened").alias("whitened"),
        F.col("own.explained").alias("explained"), "identity_error")


def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    found = personal_data.scan(docs, personal_data.learn(docs))
    base = F.filter("spans", lambda s: s["base"])
    count = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", *[count(kind).alias(f"n_{kind}") for kind in personal_data.KINDS],
        F.sha2(personal_data.listed(base).cast("binary"), 256).alias("base_sha256"),
        personal_data.listed(F.col("spans")).alias("spans"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    found = periodic_runs.find(periodic_runs.with_tails(docs)).withColumn("best", periodic_runs.best(F.col("runs")))
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"),
        F.expr("(1000 * best.length) div (-best.period)").alias("exponent_milli"),
        sha(periodic_runs.listed(F.col("runs"))).alias("runs_sha256"), sha(F.col("collapsed")).alias("collapsed_sha256"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_hidden_markov,
    op2_soft_mixing,
    op3_decontaminate,
    op4_pairwise_rank,
    op5_secret_scan,
    op6_jaccard_join,
    op7_token_frames,
    op8_html_wrapper,
    op9_quality_rules,
    op10_line_dedup,
    op11_whitening,
    op12_personal_data,
    op13_periodic_runs,
)}

#: The other queries hold trained models, tokenizers or line rules, which SQL
#: cannot express; tests/llm compares them with brute force.
ORACLE_SQL: dict[str, str] = {
    "op3_decontaminate": sql.CONTAMINATION,
    "op6_jaccard_join": sql.JACCARD_COMPONENTS,
    "op10_line_dedup": sql.LINE_DEDUP,
}
