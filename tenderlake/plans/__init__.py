"""Registered table jobs: each is a Spark plan over the driver tables plus,
where SQL can express it, an equivalent DuckDB query used as the oracle."""

from __future__ import annotations

import functools

from ..session import compiled_methods

REGISTRY: dict = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``."""
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")

        @functools.wraps(fn)
        def job(spark, sf_dir):
            compiled_methods(spark)
            return fn(spark, sf_dir)

        REGISTRY[name] = (job, sql)
        return fn
    return deco


def load_all() -> dict:
    from . import (io_jobs, label_jobs, notice_jobs, range_jobs, record_jobs, report_jobs,  # noqa: F401
                   stream_jobs, text_jobs)
    return REGISTRY
