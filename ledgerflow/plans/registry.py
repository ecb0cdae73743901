"""Registry of named jobs: key -> function(Tables) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from ..sources.adapters import Tables

JOBS: dict[str, Callable[[Tables], DataFrame]] = {}


def job(name: str):
    def deco(fn):
        JOBS[name] = fn
        return fn
    return deco


def load_all() -> dict[str, Callable[[Tables], DataFrame]]:
    from . import catalog  # noqa: F401  (registers every job)
    return JOBS
