"""The user's side of the engine: functions on groups, predicates with names,
and strategies that are chosen by name."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def by_group(rows: DataFrame, key: str, order: list[str], process: Callable[[object, Iterator[dict]], Iterator[dict]], schema: str) -> DataFrame:
    """``process(key, rows in order)`` for each key, one after the other; what
    it yields are the rows.  Groups are sorted and spilled by Spark and reach
    the function as a stream, so a group need not fit in memory."""
    columns = rows.columns

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [x.split()[0] for x in schema.split(",")]

        def stream() -> Iterator[dict]:
            for b in batches:
                for r in b[columns].itertuples(index=False, name=None):
                    yield dict(zip(columns, r))

        held: list[dict] = []
        source = stream()
        ahead = next(source, None)
        while ahead is not None:
            now = ahead[key]

            def group(now=now) -> Iterator[dict]:
                nonlocal ahead
                while ahead is not None and ahead[key] == now:
                    row, ahead = ahead, next(source, None)
                    yield row

            g = group()
            for out in process(now, g):
                held.append(out)
                if len(held) >= 4096:
                    yield pd.DataFrame(held, columns=names)
                    held = []
            for _ in g:  # what the function did not read
                pass
        if held:
            yield pd.DataFrame(held, columns=names)

    return rows.repartition(key).sortWithinPartitions(key, *order).mapInPandas(run, schema)


class Strategies:
    """Functions by name, such as the ways to correct a barcode; the caller
    adds its own."""

    def __init__(self, kind: str):
        self.kind, self.known = kind, {}

    def add(self, name: str, function: Callable) -> None:
        if name in self.known:
            raise ValueError(f"{self.kind} {name!r} is there already")
        self.known[name] = function

    def choose(self, name: str) -> Callable:
        if name not in self.known:
            raise ValueError(f"no {self.kind} {name!r}; there are {', '.join(sorted(self.known))}")
        return self.known[name]


def fates(rows: DataFrame, filters: list[tuple[str, Column]]) -> DataFrame:
    """``rows`` with ``fate``: the first filter, in order, whose predicate
    holds; null for rows that pass them all."""
    return rows.withColumn("fate", F.coalesce(*[F.when(c, F.lit(n)) for n, c in filters], F.lit(None).cast("string")))


def flag_counts(rows: DataFrame, flags: dict[str, Column], *keys: str) -> DataFrame:
    """How many rows have each flag, by key: one pass for all flags."""
    return rows.groupBy(*keys).agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in flags.items()])
