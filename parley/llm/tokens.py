"""Sizes of texts in tokens of a public tokenizer (problems 6 and 7)."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

DEFAULT_TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"

# Fixed value: the pattern that splits a text before byte-pair merging in this vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@cache
def encoding(path: str):
    """The tokenizer in a file, read once for each worker."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def with_tokens(df: DataFrame, text: str, keep: list[str], path: str = DEFAULT_TOKENIZER) -> DataFrame:
    """The columns `keep` and n_tokens of each row's whole text; 0 tokens for null and empty texts."""
    rows = df.select(*keep, F.col(text).alias("__text"))
    schema = StructType([*(rows.schema[c] for c in keep), StructField("n_tokens", LongType(), False)])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoding(path).encode_ordinary
        for batch in batches:
            sizes = pa.array([len(encode(t)) if t else 0 for t in batch.column(len(keep)).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], sizes], [*keep, "n_tokens"])

    return rows.mapInArrow(count, schema)
