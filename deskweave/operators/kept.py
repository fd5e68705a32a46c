"""Counts, facets and field profiles of a corpus, kept up to date by its upserts.

The state of a bucket is mergeable: counts, sums, extremes, and sketches of distinct values
and lengths. It is a function of the bucket's rows in one version, so it lies in a folder
named by that version, is written once and never changed. After an upsert only the buckets it
touched are read; answers are merged from the small states of the buckets that the corpus
names now. A writer that dies leaves a folder without its mark of success, which the next
one overwrites, so nothing is counted twice.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.space import hadoop_path, path_exists
from . import browse, profile
from .corpus import KEPT_POINTERS, Corpus
from .schema import FIELD_FLAGS, VECTOR_FIELD

_BUCKET = "_bucket"
PROFILED = tuple(f for f in FIELD_FLAGS if f != VECTOR_FIELD)
_FIELD_STATES = (
    "field string, records bigint, present bigint, filled bigint, max_length bigint, chars bigint, "
    "example string, values_sketch binary, lengths_sketch binary"
)
_FACET_STATES = "facet string, value string, documents bigint"


class KeptSummary:
    """What is known of a corpus without reading it.

    Another choice of fields, facets or preview length has states of its own. Every answer
    first computes the states that are missing, so it always stands for the corpus as it is.
    """

    def __init__(
        self,
        corpus: Corpus,
        fields: Sequence[str] = PROFILED,
        facets: Sequence[str] = browse.FACETS,
        preview_chars: int = profile.PREVIEW_CHARS,
    ) -> None:
        if not fields or not facets:
            raise ValueError("a summary needs a field and a facet at least")
        self.corpus, self.fields, self.preview_chars = corpus, list(fields), preview_chars
        self.facet_fields = list(facets)
        chosen = json.dumps([self.fields, self.facet_fields, preview_chars])
        self.path = f"{corpus.path}/kept/{hashlib.sha256(chosen.encode()).hexdigest()[:16]}"

    def refresh(self) -> list[int]:
        """Compute the states that are missing; returns the buckets whose rows were read."""
        versions = self.corpus.bucket_versions()
        read = set()
        for version in sorted(set(versions.values())):
            buckets = {b: v for b, v in versions.items() if v == version}
            for kind, states in (("fields", self._field_states), ("facets", self._facet_states)):
                folder = f"{self.path}/{kind}/{version}"
                if not path_exists(self.corpus.spark, f"{folder}/_SUCCESS"):
                    rows = states(self.corpus.read_buckets(buckets))
                    rows.write.mode("overwrite").partitionBy(_BUCKET).parquet(folder)
                    read |= set(buckets)
        if read:
            self._clean(set(versions.values()))
        return sorted(read)

    def _field_states(self, rows: DataFrame) -> DataFrame:
        return profile.field_states(rows, self.fields, self.preview_chars, [_BUCKET], sketches=True)

    def _facet_states(self, rows: DataFrame) -> DataFrame:
        return browse.facets(rows, self.facet_fields, [_BUCKET])

    def _states(self, kind: str, schema: str) -> DataFrame:
        self.refresh()
        spark, versions = self.corpus.spark, self.corpus.bucket_versions()
        folders = [f"{self.path}/{kind}/{v}/{_BUCKET}={b}" for b, v in sorted(versions.items())]
        if not folders:
            return spark.createDataFrame([], T.StructType.fromDDL(schema))
        return spark.read.schema(schema).parquet(*folders)

    def _clean(self, named: set[int]) -> None:
        """Delete states of versions that the last few pointers do not name any more."""
        for kind in ("fields", "facets"):
            fs, root = hadoop_path(self.corpus.spark, f"{self.path}/{kind}")
            for version in [int(s.getPath().getName()) for s in fs.listStatus(root)]:
                if version not in named and version <= max(named) - KEPT_POINTERS:
                    fs.delete(hadoop_path(self.corpus.spark, f"{self.path}/{kind}/{version}")[1], True)

    def documents(self) -> DataFrame:
        """One row: `documents`, the number of documents."""
        states = self._states("fields", _FIELD_STATES).where(F.col("field") == self.fields[0])
        return states.agg(F.coalesce(F.sum("records"), F.lit(0)).alias("documents"))

    def facets(self) -> DataFrame:
        """(facet, value, documents), as `browse.facets` of the whole corpus."""
        states = self._states("facets", _FACET_STATES)
        return states.groupBy("facet", "value").agg(F.sum("documents").alias("documents"))

    def profile(self) -> DataFrame:
        """As `profile.field_profile` of the whole corpus, and from sketches per field
        `approx_values` (distinct filled values, about 2 % off) and `median_length` (of filled
        values, about 1 % off in rank; null when there is none)."""
        return profile.merged_profile(self._states("fields", _FIELD_STATES), sketches=True)
