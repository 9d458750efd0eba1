"""Queries over the given tables, one per operator, with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from public_tokenizers import path as vocabulary_path

from . import alignment, bpe, exact_dedup, graph_dedup, html_text, mixing, near_dedup, personal, pivot_codes, secrets, topk, toxicity, warc
from .common import read_table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register the function under its own name."""

    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


@query(exact_dedup.EXACT_DEDUP_SQL)
def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts."""
    return exact_dedup.exact_groups(read_table(spark, sf_dir, "documents"))


@query()
def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's token ids and of the text they decode to."""
    return bpe.encode(read_table(spark, sf_dir, "documents"), vocabulary_path("word_bpe_49k.json"),
                      columns=("n_tokens", "ids_sha256", "decoded_sha256"))


@query()
def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a mix of all sources takes of each document."""
    return mixing.mixed_sizes(read_table(spark, sf_dir, "documents"))


@query()
def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose three-word shingles agree to 85 percent."""
    return near_dedup.near_groups(read_table(spark, sf_dir, "documents"), words_per_shingle=3, percent=85)


@query()
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Severity of every document, by a model fitted on labelled ones."""
    docs = read_table(spark, sf_dir, "documents")
    model = toxicity.train(docs, toxicity.graded(read_table(spark, sf_dir, "labels")))
    return toxicity.severity(docs, model)


@query()
def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_text.extract(read_table(spark, sf_dir, "pages"))


@query(topk.TOPK_SQL)
def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best vectors for every hundredth one."""
    vectors = read_table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.where("vec_id % 100 = 0"))


@query()
def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    return secrets.secret_digest(secrets.scan(read_table(spark, sf_dir, "documents")))


@query()
def op8_personal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    return personal.personal_digest(personal.scan(read_table(spark, sf_dir, "documents")))


@query(warc.WARC_SQL)
def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revisits of a crawl derived from all pages, resolved."""
    resolved = warc.resolve_revisits(warc.crawl_of(read_table(spark, sf_dir, "pages")))
    return resolved.withColumn("headers", warc.header_lines(resolved["headers"]))


@query(pivot_codes.PIVOT_CODES_SQL)
def op13_pivot_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all vectors, four parts of 256 entries."""
    return pivot_codes.compress(read_table(spark, sf_dir, "embeddings"))


@query()
def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aligned tokens of every document under two vocabularies."""
    return alignment.align(read_table(spark, sf_dir, "documents"), vocabulary_path("byte_bpe_50k.json"), vocabulary_path("piece_bpe_32k.model"))


@query(graph_dedup.NEAR_VECTORS_SQL)
def op11_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of vectors of a label at a cosine of 0.93 or more."""
    return graph_dedup.near_vectors(read_table(spark, sf_dir, "embeddings"))
