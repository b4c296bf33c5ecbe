"""The queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quillmesh.llm import cotraining, html_density, line_winnowing, media_mpeg, mixing, packing, quality_trees, signature_trees, substring_blocks, toxicity_kn


def _over(table: str, f: Callable[..., DataFrame], *more: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: f(*[spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in (table, *more)])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_cotraining": _over("documents", cotraining.op1, "labels"),
    "op2_signature_trees": _over("documents", lambda docs: signature_trees.near_duplicates(docs.select("doc_id", "text"))),
    "op3_substring_blocks": _over("documents", substring_blocks.op3),
    "op4_quality_trees": _over("documents", quality_trees.op4, "labels"),
    "op5_linear_grouping": _over("documents", packing.op5),
    "op6_toxicity_kn": _over("documents", toxicity_kn.op6, "labels"),
    "op7_line_winnowing": _over("documents", line_winnowing.op7),
    "op8_html_density": _over("pages", html_density.op8),
    "op9_mix_sources": _over("documents", mixing.op9),
    "op10_media_mpeg": _over("documents", media_mpeg.op10),
}

ORACLES: dict[str, str] = {}
