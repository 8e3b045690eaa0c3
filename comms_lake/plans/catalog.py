"""The named query catalog: one Spark query per operator family and, where
DuckDB can express it, the oracle SQL over the same tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_defaults

from . import (calendar_queries, doc_queries, file_queries, mail_queries, meeting_queries, misc_queries, ops_queries,
               stream_queries, text_queries)

_MODULES = [mail_queries, calendar_queries, meeting_queries, text_queries, doc_queries, ops_queries, stream_queries,
            misc_queries, file_queries]


def _with_defaults(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """Fill session settings the caller left unset (never overrides)."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ensure_defaults(spark)
        return fn(spark, sf_dir)
    run.__name__ = getattr(fn, "__name__", "query")
    run.__doc__ = fn.__doc__
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
    for mod in _MODULES:
        out.update({name: _with_defaults(fn) for name, fn in mod.QUERIES.items()})
    return out


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    for mod in _MODULES:
        out.update({k: v for k, v in mod.ORACLE.items() if v})
    return out
