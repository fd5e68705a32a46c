"""Small list files: the group dimension and the evaluation set."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Limits of an evaluation set.
MAX_QUESTIONS = 100
MAX_QUESTION_CHARS = 500


def read_groups(spark: SparkSession, path: str) -> DataFrame:
    """Lines `name | key`, '#' starts a comment line."""
    return spark.read.csv(
        path,
        schema="name string, sys_id string",
        sep="|",
        comment="#",
        ignoreLeadingWhiteSpace=True,
        ignoreTrailingWhiteSpace=True,
    ).where(F.col("sys_id").isNotNull())


def read_evaluation_set(spark: SparkSession, path: str) -> DataFrame:
    """CSV of question and expected answer below quoted comment lines and a header."""
    rows = spark.read.csv(
        path,
        schema="question string, expected_response string",
        quote='"',
        escape='"',
        multiLine=True,  # questions hold line ends
    )
    is_header = (F.col("question") == "question") & (
        F.col("expected_response") == "expectedResponse"
    )
    return rows.where(
        ~F.col("question").startswith("#") & ~F.coalesce(is_header, F.lit(False))
    )
