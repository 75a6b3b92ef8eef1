"""Stages chained over tables, batches by hint, heads and captioners, and the marks of work that is done."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass
class Stage:
    """K1. A named step of a pipeline; ``warmup`` runs before the first, ``release`` after the last, whatever happens."""

    name: str
    run: Callable[[DataFrame], DataFrame]
    warmup: Callable[[], None] = lambda: None
    release: Callable[[], None] = lambda: None


def run_stages(df: DataFrame, stages: Sequence[Stage], sink: Callable[[DataFrame], object]) -> object:
    """K1. Chains the stages and hands the result to ``sink``; names must differ. Stages that were warmed up are released even after an error."""
    if len({s.name for s in stages}) < len(stages):
        raise ValueError("two stages of one name")
    warm: list[Stage] = []
    try:
        for s in stages:
            s.warmup()
            warm.append(s)
        for s in stages:
            df = s.run(df)
        return sink(df)
    finally:
        for s in reversed(warm):
            s.release()


def by_hint(df: DataFrame, hint: str, source: str, out: str, model: Callable[[str | None, list], list], result: str = "string", salts: int = 8) -> DataFrame:
    """K9. Adds ``out``: the rows of one hint go to the model together, batch by batch, and come back to their rows.

    Rows are spread by hint and a salt, so a hint that most rows have is no single task. A result of another length than its
    input raises (K6). Null hints are a group of their own.
    """
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields) + f", `{out}` {result}"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = pd.Series([None] * len(b), index=b.index, dtype=object)
            for h, part in b.groupby(hint, dropna=False, sort=False):
                res = model(None if pd.isna(h) else h, part[source].tolist())
                if len(res) != len(part):
                    raise ValueError(f"{len(res)} results for {len(part)} inputs")
                got[part.index] = res
            yield b.assign(**{out: got})

    salted = df.repartition(F.col(hint), F.pmod(F.xxhash64(source), F.lit(salts)))
    return salted.mapInPandas(run, schema)


def captioned(df: DataFrame, source: str, out: str, generate: Callable[[list], list], most_failures: int = 3) -> DataFrame:
    """K5. Adds ``out`` from a captioner called batch by batch; a failing batch gives nulls, and ``most_failures`` in a row end the task.

    The rows of a failed batch are tried one by one before they count as failed.
    """
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields) + f", `{out}` string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        row = 0
        for b in batches:
            items = b[source].tolist()
            try:
                got, row = list(generate(items)), 0
                if len(got) != len(items):
                    raise ValueError(f"{len(got)} captions for {len(items)} prompts")
            except Exception:
                got = []
                for x in items:
                    try:
                        got.append(generate([x])[0])
                        row = 0
                    except Exception as e:
                        got.append(None)
                        row += 1
                        if row >= most_failures:
                            raise RuntimeError(f"{row} captions failed in a row") from e
            yield b.assign(**{out: got})

    return df.mapInPandas(run, schema)


def pending(published: DataFrame, finished: DataFrame, key: Sequence[str]) -> DataFrame:
    """J3. Published units without a finished result, each once; publishing again or acknowledging early changes nothing."""
    return published.select(*key).distinct().join(finished.select(*key).distinct(), list(key), "left_anti")


def drained(entries: DataFrame, marks: DataFrame, unit: str, at: str) -> DataFrame:
    """J8. Units whose mark still holds: the number of entries and the latest ``at`` are those of the mark (unit, n, latest). A late entry undoes it.

    Marks must be taken before the scan that finds a unit empty.
    """
    now = entries.groupBy(unit).agg(F.count(F.lit(1)).alias("__n"), F.max(at).alias("__t"))
    return marks.join(now, unit, "left").where((F.coalesce("__n", F.lit(0)) == F.col("n")) & F.col("__t").eqNullSafe(F.col("latest"))).select(unit)


def append_rows(df: DataFrame, path: str | None) -> None:
    """B1. Appends a batch to a table; without a path the rows are computed and dropped."""
    if path:
        df.write.mode("append").parquet(path)
    else:
        df.write.format("noop").mode("overwrite").save()
