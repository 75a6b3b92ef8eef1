"""Sizes of texts in tokens of a public tokenizer; the vocabulary file's path is a parameter."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
# Fixed value: the published splitting pattern of the byte-level vocabularies.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"


@lru_cache(maxsize=4)
def encoding(path: str):
    """The tokenizer of a ranks file, loaded once per worker."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_counts(documents: DataFrame, keep: list[str], text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """The ``keep`` columns and ``tokens`` (long): whole texts are encoded; null texts count 0."""
    fields = [f for f in documents.select(*keep).schema.fields]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", tokens long"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoding(vocabulary)
        for b in batches:
            n = [len(enc.encode_ordinary(t)) if t else 0 for t in b["__text"]]
            yield b[keep].assign(tokens=n)

    return documents.select(*keep, F.col(text).alias("__text")).mapInPandas(run, schema)
