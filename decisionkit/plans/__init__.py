"""All registered queries, one module per family."""

from __future__ import annotations

from importlib import import_module

from .base import ORACLES, QUERIES, Query

FAMILIES = ["flagship", "sources", "features", "contracts", "splitting", "relational", "encoding", "evaluation", "rare", "monitoring", "explaining", "modelling", "serving"]


def _load() -> None:
    for family in FAMILIES:
        import_module(f"{__name__}.{family}")


def queries() -> dict[str, Query]:
    _load()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(ORACLES)
