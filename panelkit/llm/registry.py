"""The registered queries of this folder, with their SQL twins."""

from __future__ import annotations

from importlib import import_module

PARTS = ("bpe", "quality_rules", "warc", "toxicity", "mixing", "minhash",
         "quality_model", "context_tree", "url_filter", "pivots", "resampling", "sharding",
         "prefix_trie")


def _merged(attribute: str) -> dict:
    merged: dict = {}
    for part in PARTS:
        merged.update(getattr(import_module(f"panelkit.llm.{part}"), attribute))
    return merged


def queries() -> dict:
    return _merged("QUERIES")


def oracle_sql() -> dict[str, str]:
    return _merged("ORACLES")
