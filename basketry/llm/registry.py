"""The queries over the operators of this subpackage, and SQL where it can state them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from basketry.llm import alignment, decontaminate, html, licenses, lines, mixing, neardup, passages, quality, tokens
from basketry.llm import vectors, warc, whitening

TOKENIZER = "word_bpe_49k.json"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def op2_token_frames(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return tokens.read_shards(tokens.write_shards(docs, public_tokenizers.path(TOKENIZER)))


def op1_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(table(spark, folder, "documents"))


def op3_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return html.extract(table(spark, folder, "pages"))


def op4_neardup_forest(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.classes(table(spark, folder, "documents"), width=3, percent=85)


def op5_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.evaluate(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op6_vector_graph(spark: SparkSession, folder: str) -> DataFrame:
    return vectors.classes(table(spark, folder, "embeddings"), threshold=0.98)


def op7_warc(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    found = warc.read(warc.normalise(warc.write_monolithic(pages, min_bytes=0)))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_benchmark_templates(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.drop("text_key")


def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    drawn = mixing.plan(table(spark, folder, "documents"))
    taken = F.col("size") * F.size("copies")
    return drawn.select("doc_id", "size", "source_size", "target", taken.alias("taken"), "source", "copies")


def op10_paragraph_bands(spark: SparkSession, folder: str) -> DataFrame:
    return passages.repeats(table(spark, folder, "documents"))


def op11_line_bitmaps(spark: SparkSession, folder: str) -> DataFrame:
    return lines.report(table(spark, folder, "documents"))


def op12_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return alignment.report(table(spark, folder, "documents"), *paths)


def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.report(table(spark, folder, "embeddings"))


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    return corpus_pipeline.run(spark, folder)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_license_scan": op1_license_scan,
    "op2_token_frames": op2_token_frames,
    "op3_html_text": op3_html_text,
    "op4_neardup_forest": op4_neardup_forest,
    "op5_quality": op5_quality,
    "op6_vector_graph": op6_vector_graph,
    "op7_warc": op7_warc,
    "op8_benchmark_templates": op8_benchmark_templates,
    "op9_mixing": op9_mixing,
    "op10_paragraph_bands": op10_paragraph_bands,
    "op11_line_bitmaps": op11_line_bitmaps,
    "op12_token_alignment": op12_token_alignment,
    "op13_whitening": op13_whitening,
    "pipeline": pipeline,
}

SQL: dict[str, str] = {"op1_license_scan": licenses.scan_sql(), "op7_warc": warc.read_sql(), "op11_line_bitmaps": lines.report_sql()}
