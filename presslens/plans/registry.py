"""Query registry: every query is a Spark builder plus (optionally) an
independent DuckDB SQL oracle over the same parquet tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    build: Builder
    oracle: str | None
    ids: tuple[str, ...] = field(default_factory=tuple)
    doc: str = ""


REGISTRY: dict[str, Query] = {}


def register(name: str, oracle: str | None = None, ids: tuple[str, ...] = ()):
    """Decorator: register ``fn(spark, sf_dir) -> DataFrame`` under ``name``."""

    def deco(fn: Builder) -> Builder:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, oracle, tuple(ids), (fn.__doc__ or "").strip())
        return fn

    return deco


def load_all() -> dict[str, Query]:
    # importing the plan modules fills REGISTRY
    from presslens.plans import (  # noqa: F401
        charts,
        cleaning,
        live,
        pages,
        storage,
        feeds,
        catalogue,
        streams,
        analysis,
    )
    return REGISTRY
