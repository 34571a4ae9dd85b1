"""Registered queries over the order-line and text tables, with SQL twins."""

from __future__ import annotations

from importlib import import_module

PARTS = ("panel", "series", "analytics", "inventory", "text", "models", "explained")


def _merged(attribute: str) -> dict:
    merged: dict = {}
    for part in PARTS:
        merged.update(getattr(import_module(f"panelkit.catalog.{part}"), attribute))
    return merged


def queries() -> dict:
    return _merged("QUERIES")


def oracle_sql() -> dict[str, str]:
    return _merged("ORACLES")
