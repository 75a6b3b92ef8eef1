"""Model slots: named, validated, vectorised plug-ins with a check of what they return; hash-based stubs for tests."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame

SLOTS = ("separator", "diarizer", "vad", "language", "asr", "quality", "head", "captioner")
_registry: dict[tuple[str, str], tuple[Callable, str, frozenset]] = {}


@dataclass(frozen=True)
class Slot:
    """A model by slot and name with its parameters."""

    slot: str
    name: str
    params: tuple[tuple[str, object], ...] = ()


def register(slot: str, name: str, factory: Callable, result: str, params: tuple[str, ...] = ()) -> None:
    """``factory(**params)`` gives a function of a pandas Series of inputs to a list of as many outputs of SQL type ``result``."""
    if slot not in SLOTS:
        raise ValueError(f"no slot {slot}; there are {', '.join(SLOTS)}")
    _registry[slot, name] = (factory, result, frozenset(params))


def resolve(s: Slot) -> tuple[Callable, str]:
    """The factory and result type, checked while planning; unknown slots, names and parameters raise."""
    if s.slot not in SLOTS:
        raise ValueError(f"no slot {s.slot}")
    if (s.slot, s.name) not in _registry:
        raise ValueError(f"no {s.slot} called {s.name}")
    factory, result, known = _registry[s.slot, s.name]
    if extra := {k for k, _ in s.params} - known:
        raise ValueError(f"{s.name} has no parameter {', '.join(sorted(extra))}")
    return factory, result


def apply_slot(df: DataFrame, s: Slot, source: str, out: str) -> DataFrame:
    """Adds ``out``. The model is built once per task; a result of another length than its input raises, so nothing shifts."""
    factory, result = resolve(s)
    params = dict(s.params)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields) + f", `{out}` {result}"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = factory(**params)
        for b in batches:
            got = list(model(b[source]))
            if len(got) != len(b):
                raise ValueError(f"{s.name} returned {len(got)} results for {len(b)} inputs")
            yield b.assign(**{out: got})

    return df.mapInPandas(run, schema)


def _stub_score(seed: int = 0):
    return lambda xs: [None if x is None else zlib.crc32(f"{seed}:{x}".encode()) % 400 / 100 + 1 for x in xs]


def _stub_language():
    return lambda xs: [None if x is None else ("en", "de", "zh", "ja")[zlib.crc32(str(x).encode()) % 4] for x in xs]


register("quality", "stub", _stub_score, "double", ("seed",))
register("language", "stub", _stub_language, "string")
