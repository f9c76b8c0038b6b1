"""Operators for training-data pipelines, one module each, with the queries that apply them to whole tables."""

from __future__ import annotations

from importlib import import_module

from tidemark.llm.registry import QUERIES
from tidemark.queries.registry import Query

MODULES = (
    "crc_resampling",
    "learned_partitions",
    "licences",
    "mixing",
    "outliers",
    "packing_histogram",
    "piece_encoding",
    "pitman_yor",
    "prefix_trie",
    "run_index",
    "simhash_trie",
    "toxicity",
    "warc",
)


def all_queries() -> dict[str, Query]:
    for name in MODULES:
        import_module(f"tidemark.llm.{name}")
    return dict(QUERIES)
