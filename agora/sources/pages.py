"""Flattening of landed API pages (one JSON document per page) into tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

OWNER = "owner struct<user_id: bigint, display_name: string, reputation: bigint>"
ITEMS = {
    "users": "user_id bigint, display_name string, reputation bigint, "
    "badge_counts struct<gold: bigint, silver: bigint, bronze: bigint>",
    "questions": f"question_id bigint, tags array<string>, score double, accepted_answer_id bigint, {OWNER}",
    "answers": f"answer_id bigint, question_id bigint, is_accepted boolean, score double, {OWNER}",
}


def page_schema(kind: str) -> T.StructType:
    item = T.StructType.fromDDL(ITEMS[kind])
    return T.StructType(
        [
            T.StructField("items", T.ArrayType(item)),
            T.StructField("has_more", T.BooleanType()),
            T.StructField("feed", T.StringType()),
            T.StructField("page", T.LongType()),
        ]
    )


def read_pages(spark: SparkSession, path: str, kind: str, multi_line: bool = False) -> DataFrame:
    return spark.read.schema(page_schema(kind)).json(path, multiLine=multi_line)


def _items(pages: DataFrame, keep: Sequence[str]) -> DataFrame:
    return pages.select(*keep, F.inline("items"))


def _owner_columns() -> list[Column]:
    """Reputation defaults to 0, but only where there is an owner."""
    reputation = F.when(F.col("owner").isNotNull(), F.coalesce("owner.reputation", F.lit(0)))
    return [
        F.col("owner.user_id").alias("user_id"),
        F.col("owner.display_name").alias("display_name"),
        reputation.alias("reputation"),
    ]


def flatten_users(pages: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    badges = [
        F.coalesce(f"badge_counts.{metal}", F.lit(0)).alias(f"{metal}_badges") for metal in ("gold", "silver", "bronze")
    ]
    return _items(pages, keep).select(*keep, "user_id", "display_name", "reputation", *badges)


def flatten_questions(pages: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    user_id, display_name, reputation = _owner_columns()
    return _items(pages, keep).select(
        *keep, "question_id", "tags", "score", user_id, reputation, display_name, "accepted_answer_id"
    )


def flatten_answers(pages: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return _items(pages, keep).select(*keep, "answer_id", "question_id", *_owner_columns(), "is_accepted", "score")


FLATTEN = {"users": flatten_users, "questions": flatten_questions, "answers": flatten_answers}
KEYS = {"users": "user_id", "questions": "question_id", "answers": "answer_id"}
