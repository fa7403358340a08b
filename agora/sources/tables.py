"""Reading and writing flat tables, under an explicit schema or one that is inferred."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agora.functions.cleaning import na_to_null, nan_to_null, to_id

QA_USERS = (
    "user_id bigint, display_name string, reputation bigint, gold_badges bigint, silver_badges bigint, bronze_badges bigint"
)
QA_QUESTIONS = (
    "question_id bigint, tags string, score double, user_id bigint, reputation bigint, display_name string, accepted_answer_id bigint"
)
QA_ANSWERS = (
    "answer_id bigint, question_id bigint, user_id bigint, display_name string, reputation bigint, is_accepted boolean, score double"
)
FORUM_POSTS = "post_id string, author string, score string, num_comments bigint"
FORUM_COMMENTS = "post_id string, parent_id string, author string, score string"


def read_table(
    spark: SparkSession, path: str, schema: str | T.StructType | None = None, fmt: str = "csv", multi_line: bool | None = None
) -> DataFrame:
    """Scan CSV or Parquet; missing-value spellings and NaN become NULL.

    CSV cells are read as text and converted, so ``12.0`` still is the id 12
    and a bad cell is NULL instead of an error. Without a schema the types are
    those of ``infer_types``. ``multi_line`` allows quoted line breaks but makes
    a file one task; if it is not given, the file is looked through for such
    breaks first, and files without them stay splittable.
    """
    if fmt == "csv" and multi_line is None:
        multi_line = has_quoted_breaks(spark, path)
    if schema is None:
        schema = infer_types(spark, path, multi_line) if fmt == "csv" else spark.read.format(fmt).load(path).schema
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    if fmt != "csv":
        stored = spark.read.format(fmt).load(path)
        return stored.select(*[_without_nan(f) for f in schema.fields])
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    cells = _cells(spark, path, multi_line, text)
    return cells.select(*[_typed(f) for f in schema.fields])


def _cells(spark: SparkSession, path: str, multi_line: bool, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.csv(path, header=True, multiLine=multi_line, quote='"', escape='"')


def has_quoted_breaks(spark: SparkSession, path: str) -> bool:
    """Whether a line of the files has an odd number of quotes, so that a cell goes on in the next line."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return not spark.read.text(path).where(quotes % 2 == 1).isEmpty()


def infer_types(spark: SparkSession, path: str, multi_line: bool | None = None) -> T.StructType:
    """The narrowest type that takes every cell of a column: bigint, double, boolean, else string.

    One aggregation over all rows; cells that spell a missing value count for
    nothing, and a column of only such cells is double.
    """
    multi_line = has_quoted_breaks(spark, path) if multi_line is None else multi_line
    cells = _cells(spark, path, multi_line)
    if not cells.columns:
        return T.StructType([])

    def fails(cell: Column, parsed: Column) -> Column:
        return F.coalesce(F.bool_or(cell.isNotNull() & parsed.isNull()), F.lit(False))

    tests = []
    for name in cells.columns:
        cell = na_to_null(F.col(f"`{name}`"))
        whole = F.when(cell.rlike(r"^\s*[+-]?[0-9]+\s*$"), cell.try_cast("bigint"))
        # A trailing type letter ("1d", "2F") is text.
        number = F.when(~cell.rlike(r"[0-9.][dDfF]\s*$"), cell.try_cast("double"))
        flag = F.when(F.lower(cell).isin("true", "false"), F.lit(True))
        tests += [fails(cell, whole), fails(cell, number), fails(cell, flag), F.count(cell) == 0]
    found = cells.agg(F.array(*tests).alias("t")).first()["t"]
    fields = []
    for k, name in enumerate(cells.columns):
        no_whole, no_number, no_flag, empty = found[4 * k : 4 * k + 4]
        kind = T.DoubleType() if empty else T.LongType() if not no_whole else T.DoubleType() if not no_number else None
        fields.append(T.StructField(name, kind or (T.StringType() if no_flag else T.BooleanType())))
    return T.StructType(fields)


def _without_nan(field: T.StructField):
    column = F.col(field.name)
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        column = nan_to_null(column)
    return column.cast(field.dataType).alias(field.name)


def _typed(field: T.StructField):
    cell = na_to_null(F.col(f"`{field.name}`"))
    if isinstance(field.dataType, T.LongType):
        cell = to_id(cell)
    elif isinstance(field.dataType, T.DoubleType):
        cell = nan_to_null(cell.try_cast("double"))
    elif not isinstance(field.dataType, T.StringType):
        cell = cell.try_cast(field.dataType)
    return cell.alias(field.name)


def write_table(
    df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] | None = None
) -> None:
    """Overwrite a table; ``csv`` writes a header and no index column."""
    options = {"header": True, "escape": '"'} if fmt == "csv" else {}
    df.write.save(path, format=fmt, mode="overwrite", partitionBy=list(partition_by or []), **options)
