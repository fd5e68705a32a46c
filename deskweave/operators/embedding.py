"""Vectors for documents and queries, from an injected model or an offline one."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import md5

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import words
from .schema import DEFAULT_DIMENSIONS, VECTOR_FIELD

Embedder = Callable[[list[str]], list[list[float]]]

# Texts per model call, input limits of the model, tries per call.
CALL_TEXTS = 16
MAX_INPUT_TOKENS = 8_000
MAX_INPUT_CHARS = 24_000
ATTEMPTS = 4

# Rows that the offline model counts at once, words whose hashes a task keeps.
ROWS_AT_ONCE = 256
KNOWN_WORDS = 200_000


def embed_with(
    make_embedder: Callable[[], Embedder],
    text: Column,
    call_texts: int = CALL_TEXTS,
    max_chars: int = MAX_INPUT_CHARS,
    make_tokenizer: Callable[[], object] | None = None,
    max_tokens: int = MAX_INPUT_TOKENS,
    attempts: int = ATTEMPTS,
) -> Column:
    """array<float> per text; empty texts get null and are not sent.

    A text longer than a model input is sent in consecutive windows, by tokens when a
    tokenizer with encode/decode is given, otherwise by characters. Its vector is the mean
    of the windows' vectors weighted by their lengths, scaled to length one. A call that
    keeps failing fails the task, which Spark runs again.
    """

    @F.pandas_udf("array<float>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        embed = make_embedder()
        tokenizer = make_tokenizer() if make_tokenizer else None

        def windows(body: str) -> list[tuple[str, int]]:
            """Inputs and their lengths."""
            if tokenizer is None:
                parts = [body[i : i + max_chars] for i in range(0, len(body), max_chars)]
                return [(p, len(p)) for p in parts]
            tokens = tokenizer.encode(body)
            if len(tokens) <= max_tokens:
                return [(body, len(tokens))]
            parts = [tokens[i : i + max_tokens] for i in range(0, len(tokens), max_tokens)]
            return [(tokenizer.decode(p), len(p)) for p in parts]

        def call(inputs: list[str]) -> np.ndarray:
            for attempt in range(attempts):
                try:
                    vectors = np.asarray(embed(inputs), np.float32)
                    if len(vectors) != len(inputs):
                        raise ValueError("an embedder must return one vector per text")
                    return vectors
                except Exception:
                    if attempt == attempts - 1:
                        raise
            raise ValueError("attempts must be positive")

        def mean(vectors: list[np.ndarray], lengths: list[int]) -> np.ndarray:
            if len(vectors) == 1:
                return vectors[0]
            total = np.average(np.stack(vectors), axis=0, weights=lengths)
            return (total / (np.linalg.norm(total) or 1.0)).astype(np.float32)

        for texts in batches:
            sent = [(i, *part) for i, body in enumerate(texts) if body for part in windows(body)]
            found: dict[int, tuple[list, list]] = {}
            for at in range(0, len(sent), call_texts):
                part = sent[at : at + call_texts]
                for (i, _, length), vector in zip(part, call([p for _, p, _ in part])):
                    own = found.setdefault(i, ([], []))
                    own[0].append(vector)
                    own[1].append(length)
            yield pd.Series(
                [mean(*found[i]) if i in found else None for i in range(len(texts))], dtype=object
            )

    return run.asNondeterministic()(text)


def embed_documents(
    documents: DataFrame, make_embedder: Callable[[], Embedder], column: str = "content", **options
) -> DataFrame:
    """Add the vector of a text column."""
    return documents.withColumn(
        VECTOR_FIELD, embed_with(make_embedder, F.col(column), **options)
    )


def hash_embed(
    documents: DataFrame,
    column: str = "content",
    dimensions: int = DEFAULT_DIMENSIONS,
    element: str = "float",
) -> DataFrame:
    """Offline model: hashed word counts of the whole text, scaled to length one.

    Deterministic; words are hashed by MD5, so that any engine gives the same vector. Use the
    same function for documents and queries, so that both live in one vector space. Spark
    splits the texts; a task hashes each word of some rows once and counts places by numpy.
    """

    @F.arrow_udf(f"array<{element}>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        places: dict[str, int] = {}
        kind = pa.list_(pa.float32() if element == "float" else pa.float64())
        for batch in batches:
            parts = [
                _hash_vectors(batch.slice(at, ROWS_AT_ONCE), dimensions, places).cast(kind)
                for at in range(0, len(batch), ROWS_AT_ONCE)
            ]
            yield pa.concat_arrays(parts) if parts else pa.array([], kind)

    return documents.withColumn(VECTOR_FIELD, run.asNondeterministic()(words(F.col(column))))


def _hash_vectors(texts: pa.Array, dimensions: int, places: dict[str, int]) -> pa.Array:
    """A vector of doubles per list of words, null for an empty one; `places` are known hashes."""
    coded = pc.list_flatten(texts).dictionary_encode()
    if len(places) > KNOWN_WORDS:
        places.clear()
    place = np.empty(len(coded.dictionary), np.int64)
    for i, word in enumerate(coded.dictionary.to_pylist()):
        found = places.get(word)
        if found is None:
            digest = md5(word.encode("utf-8", "surrogatepass"), usedforsecurity=False).digest()
            found = places[word] = int.from_bytes(digest[:3], "big") % dimensions
        place[i] = found
    lengths = pc.fill_null(pc.list_value_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(texts)), lengths)
    at = row * dimensions + place[coded.indices.to_numpy(zero_copy_only=False)]
    counts = np.bincount(at, minlength=len(texts) * dimensions).reshape(len(texts), dimensions)
    some = lengths > 0
    kept = counts[some].astype(np.float64)
    kept /= np.sqrt((kept * kept).sum(axis=1))[:, None]
    ends = np.concatenate(([0], np.cumsum(some))) * dimensions
    return pa.ListArray.from_arrays(
        pa.array(ends, pa.int32()), pa.array(kept.ravel()), mask=pa.array(~some)
    )


def check_vectors(
    documents: DataFrame, dimensions: int, column: str = VECTOR_FIELD
) -> DataFrame:
    """One row: how many vectors there are and whether their length is right."""
    length = F.size(F.col(column))
    has = F.col(column).isNotNull() & (length > 0)
    return documents.agg(
        F.count(F.lit(1)).alias("documents"),
        F.count_if(has).alias("vectors"),
        F.count_if(has & (length != dimensions)).alias("wrong_length"),
        F.min(F.when(has, length)).cast("bigint").alias("min_length"),
        F.max(F.when(has, length)).cast("bigint").alias("max_length"),
    )
