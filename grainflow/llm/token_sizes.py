"""Sizes of texts in tokens of a public tokenizer, whose vocabulary file is a parameter."""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = os.environ.get("GRAINFLOW_TOKENIZER", "/opt/tokenizers/byte_bpe_50k.tiktoken")
# fixed value: how the byte-level vocabulary's tokenizer cuts a text before merging
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_LOADED: dict = {}


def encoder(path: str):  # noqa: ANN201
    """The tokenizer of a file of base64 tokens and ranks, loaded once per Python worker."""
    if path not in _LOADED:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _LOADED[path] = tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _LOADED[path]


def count_tokens(text: str, path: str = VOCABULARY) -> int:
    """Tokens of a text, whole; the time is about in proportion to its length, even for a run without blanks."""
    return len(encoder(path).encode_ordinary(text))


def token_sizes(df: DataFrame, key: str, text: str, keep: tuple[str, ...] = (), path: str = VOCABULARY) -> DataFrame:
    """key, the columns named in keep, and tokens of each row; a null or empty text has 0 tokens."""
    src = df.select(F.col(key).alias("key"), *(F.col(c) for c in keep), F.col(text).alias("text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = [count_tokens(t, path) if t else 0 for t in b.column(b.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(n, pa.int64())], names=[*b.schema.names[:-1], "tokens"])

    return src.mapInArrow(run, f"{kinds}, tokens bigint")
