"""Extension points: row functions, record transforms and table functions by name."""

from __future__ import annotations

import importlib
from collections.abc import Callable, Iterable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.functions import udtf

from vistaloom.operators import adapters

ADAPTERS: dict[str, Callable[..., adapters.Adapter]] = {"passthrough": lambda: adapters.passthrough}


def adapter(name: str):
    """Registers a factory of an adapter; its parameters come from the data set's config."""

    def register(f):
        ADAPTERS[name] = f
        return f

    return register


def make_adapter(name: str, **params) -> adapters.Adapter:
    """An adapter by its registered name, or by ``module:function``."""
    factory = ADAPTERS.get(name)
    if factory is None:
        module, _, attribute = name.partition(":")
        if not attribute:
            raise ValueError(f"no adapter {name}")
        factory = getattr(importlib.import_module(module), attribute)
    return factory(**params)


def apply_rows(rows: DataFrame, f: Callable[[dict, int], tuple[dict, bool]], schema: str) -> DataFrame:
    """``f(row, index within its task) -> (row, keep)`` over every row, in Arrow batches; the slow path, for what columns cannot say."""

    def run(batches: Iterable[pd.DataFrame]):
        n = 0
        for b in batches:
            out = []
            for r in b.to_dict("records"):
                row, keep = f(r, n)
                n += 1
                if keep:
                    out.append(row)
            if out:
                yield pd.DataFrame(out)

    return rows.mapInPandas(run, schema)


def register_items(spark: SparkSession, name: str, f: Callable[..., Iterable[tuple]], schema: str) -> None:
    """Registers a generator as a SQL table function: 0 to n rows for each input row."""

    class Items:
        def eval(self, *values):
            yield from f(*values)

    spark.udtf.register(name, udtf(Items, returnType=schema))
