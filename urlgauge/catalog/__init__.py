"""Every operator as a runnable query over the given tables, with SQL twins."""

from __future__ import annotations

from .registry import ORACLES, QUERIES


def _load() -> None:
    from . import learning_queries, stream_queries, table_queries, url_queries  # noqa: F401


def queries():
    _load()
    return dict(QUERIES)


def oracles():
    _load()
    return dict(ORACLES)
