"""Every operator as a query over the given tables, with equal SQL where there is any."""

from __future__ import annotations

from importlib import import_module

MODULES = ["sources", "filters", "functions", "slots", "marks", "social", "indicators", "ordering",
           "places", "evaluation", "surfaces", "streams"]


def _collect(attribute: str) -> dict:
    out: dict = {}
    for name in MODULES:
        part = getattr(import_module(f"dayprints.catalog.{name}"), attribute)
        clash = out.keys() & part.keys()
        if clash:
            raise ValueError(f"keys defined twice: {sorted(clash)}")
        out.update(part)
    return out


def queries() -> dict:
    return _collect("QUERIES")


def oracle_sql() -> dict[str, str]:
    return _collect("ORACLES")
