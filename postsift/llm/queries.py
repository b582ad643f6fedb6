"""Queries that apply each operator, with its production settings, to whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postsift.llm.bloom_lm import lm_scores
from postsift.llm.html_text import main_texts
from postsift.llm.language import document_languages, page_languages
from postsift.llm.lexical import lexical_search
from postsift.llm.licenses import license_digest, license_spans
from postsift.llm.mixing import mixed_sizes
from postsift.llm.neighbours import nearest
from postsift.llm.packing import packed
from postsift.llm.quality import quality
from postsift.llm.superminhash import near_duplicates
from postsift.llm.trie import prefix_trie
from postsift.llm.vertical import jaccard_groups
from postsift.llm.warc import archived_pages
from postsift.sources.durable import fresh_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_languages(_table(spark, sf_dir, "documents"))


def page_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_languages(_table(spark, sf_dir, "pages"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(_table(spark, sf_dir, "documents"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived_pages(_table(spark, sf_dir, "pages"), fresh_path(spark, "warc")).drop("n_pieces")


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(_table(spark, sf_dir, "documents"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed_sizes(_table(spark, sf_dir, "documents")).drop("row_key")


def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_digest(license_spans(_table(spark, sf_dir, "documents")))


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_texts(_table(spark, sf_dir, "pages"))


def op10_superminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"), width=2, percent=80)


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_groups(_table(spark, sf_dir, "documents"), width=4, percent=85)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(_table(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_quality_rules": op3_quality_rules,
    "op4_warc": op4_warc,
    "op5_lm_scoring": op5_lm_scoring,
    "op6_mixing": op6_mixing,
    "op7_nearest_neighbours": op7_nearest_neighbours,
    "op8_license_scan": op8_license_scan,
    "op9_html_text": op9_html_text,
    "op10_superminhash": op10_superminhash,
    "op11_lexical_search": op11_lexical_search,
    "op12_jaccard_join": op12_jaccard_join,
    "op13_prefix_trie": op13_prefix_trie,
    "page_language_id": page_language_id,
}
