"""Embeddings from any provider, batched and retried inside Arrow batches.

A provider is a picklable callable from a list of texts to a list of vectors; it is set up once per worker. The one that
is built in needs no network: words are hashed into signed buckets and the vector is scaled to length one.
"""

from __future__ import annotations

import os
import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from lexquarry.operators.chunking import TokenCounter, quarter

Provider = Callable[[list[str]], Sequence[Sequence[float]]]


class EmbeddingError(Exception):
    """The provider gave no usable vectors."""


class ConnectionFailed(EmbeddingError):
    """The provider can't be reached."""


class ModelMissing(EmbeddingError):
    """The provider has no such model."""


class NotAuthorised(EmbeddingError):
    """A key is missing or was refused."""


class WrongDimension(EmbeddingError):
    """Vectors of another size; trying again would not help."""


@dataclass(frozen=True)
class EmbedConfig:
    provider: str = "hashing"
    model: str = "words"
    dimensions: int = 768
    batch_size: int = 32
    max_tokens: int = 7500
    max_retries: int = 3
    retry_delay: float = 1.0

    def __post_init__(self):
        for name, least in (("dimensions", 1), ("batch_size", 1), ("max_tokens", 1), ("max_retries", 0), ("retry_delay", 0)):
            if getattr(self, name) < least:
                raise ValueError(f"{name} must be {least} or more, got {getattr(self, name)}")
        if not self.model:
            raise ValueError("model must not be empty")


class HashingProvider:
    """Signed word counts in hashed buckets, of length one; a text without words is the zero vector."""

    def __init__(self, dimensions: int = 768):
        self.dimensions = dimensions

    def __call__(self, texts: list[str]) -> list[list[float]]:
        import xxhash

        out = []
        for text in texts:
            v = np.zeros(self.dimensions, np.float64)
            for word in text.lower().split():
                h = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"), 0)
                v[(h >> 1) % self.dimensions] += 1 if h & 1 else -1
            n = np.linalg.norm(v)
            out.append((v / n if n else v).astype(np.float32).tolist())
        return out


def api_key(name: str) -> str:
    """A key from the environment."""
    key = os.environ.get(name, "").strip()
    if not key:
        raise NotAuthorised(f"{name} is not set")
    return key


def token_batches(texts: Sequence[str], max_tokens: int = 7500, max_items: int = 32, count: TokenCounter = quarter) -> list[list[str]]:
    """In order, as many texts as fit; a text that is too long is a batch of its own."""
    out: list[list[str]] = []
    room = items = 0  # what the last batch can still take; none before the first
    for text in texts:
        n = count(text)
        if n > max_tokens or n > room or not items:
            out.append([])
            room, items = (0, 0) if n > max_tokens else (max_tokens, max_items)
        out[-1].append(text)
        if n <= max_tokens:
            room, items = room - n, items - 1
    return out


def fixed_batches(texts: Sequence[str], size: int) -> list[list[str]]:
    return [list(texts[i : i + size]) for i in range(0, len(texts), size)]


def with_retries(call: Callable[[], list], config: EmbedConfig, sleep: Callable[[float], None] = time.sleep) -> list:
    """Call again after a failure, each time after twice the time; a wrong dimension is final."""
    for attempt in range(config.max_retries + 1):
        try:
            vectors = call()
            if len(vectors) and len(vectors[0]) != config.dimensions:
                raise WrongDimension(f"expected {config.dimensions} dimensions, got {len(vectors[0])}")
            return vectors
        except WrongDimension:
            raise
        except Exception as e:
            if attempt == config.max_retries:
                raise e if isinstance(e, EmbeddingError) else EmbeddingError(str(e)) from e
            sleep(config.retry_delay * 2**attempt)
    raise AssertionError


def embed_texts(texts: Sequence[str], provider: Provider, config: EmbedConfig) -> np.ndarray:
    """A float32 matrix, one row per text, in order."""
    out = [v for batch in token_batches(texts, config.max_tokens, config.batch_size) for v in with_retries(lambda batch=batch: provider(batch), config)]
    return np.array(out, np.float32).reshape(len(texts), config.dimensions)


def embed(text: Column, provider: Provider | None = None, config: EmbedConfig = EmbedConfig()) -> Column:
    """(embedding, error) of a text column; what fails is an error of its batch's rows, and the job goes on."""
    call = provider or HashingProvider(config.dimensions)

    @F.pandas_udf("struct<embedding:array<float>,error:string>")
    def embedded(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            vectors, errors = [], []
            for own in token_batches([t or "" for t in batch], config.max_tokens, config.batch_size):
                try:
                    vectors += [list(map(float, v)) for v in with_retries(lambda own=own: call(own), config)]
                    errors += [None] * len(own)
                except EmbeddingError as e:
                    vectors += [None] * len(own)
                    errors += [f"{type(e).__name__}: {e}"] * len(own)
            yield pd.DataFrame({"embedding": vectors, "error": errors})

    return embedded.asNondeterministic()(text)  # so that the planner never copies it into what reads it


def embed_chunks(chunks: DataFrame, provider: Provider | None = None, config: EmbedConfig = EmbedConfig(), text_col: str = "text") -> DataFrame:
    out = chunks.withColumn("_e", embed(F.col(text_col), provider, config))
    return out.select(*chunks.columns, "_e.embedding", F.col("_e.error").alias("embedding_error"))


def preflight(provider: Provider, config: EmbedConfig) -> None:
    """One test call on the driver; raises what a job would run into."""
    embed_texts(["test"], provider, config)


def batch_ids(df: DataFrame, group_col: str, order_col: str, tokens_col: str, max_tokens: int, max_items: int) -> DataFrame:
    """The number of the token-aware batch of each row, within its group in order; null counts are none.

    Rows stream through in order, so a task holds an Arrow batch, however large the group. One group is one task's, as each batch hangs on the
    one before: group by article, not by source.
    """
    own = df.select(group_col, order_col, tokens_col)
    names = [*own.columns, "batch"]

    def numbered(batches: Iterator) -> Iterator:
        import pyarrow as pa

        last, number, room, items = (), -1, 0, 0
        for part in batches:
            ids = []
            for group, n in zip(part.column(0).to_pylist(), part.column(2).to_pylist(), strict=True):
                if last != (group,):
                    last, number, room, items = (group,), -1, 0, 0
                n = n or 0
                if n > max_tokens or n > room or items < 1:
                    number += 1
                    room, items = (0, 0) if n > max_tokens else (max_tokens, max_items)
                if n <= max_tokens:
                    room, items = room - n, items - 1
                ids.append(number)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(ids, pa.int64())], names=names)

    return own.repartition(group_col).sortWithinPartitions(group_col, order_col).mapInArrow(numbered, StructType([*own.schema.fields, StructField("batch", LongType())]))
