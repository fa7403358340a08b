"""Forum and Q&A tables derived from the order tables, for queries and tests.

``SQL`` holds the same views for the SQL engine that checks the results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def qa_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    priority = F.substring("o_orderpriority", 1, 1)
    badges = (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("user_id"))
        .agg(
            F.count_if(priority == "1").alias("gold_badges"),
            F.count_if(priority == "2").alias("silver_badges"),
            F.count_if(priority == "3").alias("bronze_badges"),
        )
    )
    people = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"),
        F.col("c_name").alias("display_name"),
        (F.floor(F.greatest("c_acctbal", F.lit(0.0))).cast("bigint") + 1).alias("reputation"),
    )
    return people.join(badges, "user_id", "left").fillna(0, ["gold_badges", "silver_badges", "bronze_badges"])


PRIME, MIXERS = 2147483647, (48271, 69621)


def _line_hash(mixer: int) -> Column:
    """Polynomial of the columns that identify a line, modulo a 31-bit prime."""
    cents = F.floor(F.col("l_extendedprice") * 100 + 0.5).cast("bigint")
    value = F.col("l_orderkey") % PRIME
    for part in (F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey"), cents):
        value = (value * F.lit(mixer).cast("bigint") + part) % PRIME
    return value


def qa_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An answer for every line; its id joins two hashes of the line."""
    first, second = (_line_hash(m) for m in MIXERS)
    return table(spark, sf_dir, "lineitem").select(
        (F.shiftleft(first, 31) + second).alias("answer_id"),
        F.col("l_orderkey").alias("question_id"),
        F.col("l_partkey").alias("user_id"),
        (F.col("l_quantity") - 25).alias("score"),
        (F.col("l_returnflag") == "A").alias("is_accepted"),
    )


def qa_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    accepted = (
        qa_answers(spark, sf_dir)
        .where("is_accepted")
        .groupBy("question_id")
        .agg(F.min("answer_id").alias("accepted_answer_id"))
    )
    asked = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("question_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_totalprice").alias("score"),
    )
    return asked.join(accepted, "question_id", "left")


def forum_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    replies = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.count(F.lit(1)).alias("num_comments"))
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return orders.join(replies, "o_orderkey", "left").select(
        F.col("o_orderkey").cast("string").alias("post_id"),
        F.concat(F.lit("u"), F.col("o_custkey").cast("string")).alias("author"),
        F.floor("o_totalprice").cast("double").alias("score"),
        F.coalesce("num_comments", F.lit(0)).alias("num_comments"),
    )


def forum_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qa_answers(spark, sf_dir).select(
        F.col("answer_id").alias("comment_id"),
        F.concat(F.lit("t3_"), F.col("question_id").cast("string")).alias("post_id"),
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("author"),
        "score",
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores with two logits, dealt to batches of 64 rows and five epochs."""
    prob = F.col("value") / 500
    batch = F.floor(F.col("event_id") / 64).cast("bigint")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("key"),
        prob.alias("prob"),
        (prob >= 0.5).cast("int").alias("pred"),
        (F.col("event_type") == "purchase").cast("int").alias("label"),
        (0.5 - prob).alias("z0"),
        (prob - 0.5).alias("z1"),
        batch.alias("batch_id"),
        F.pmod(batch, F.lit(5)).cast("int").alias("epoch"),
    )


def _line_hash_sql(mixer: int) -> str:
    value = "l_orderkey % 2147483647"
    for part in ("l_linenumber", "l_partkey", "l_suppkey", "cast(floor(l_extendedprice * 100 + 0.5) as bigint)"):
        value = f"(({value}) * {mixer} + {part}) % 2147483647"
    return f"({value})"


SQL = {
    "qa_users": """
        select c_custkey user_id, c_name display_name,
               cast(floor(greatest(c_acctbal, 0)) as bigint) + 1 reputation,
               coalesce(g, 0) gold_badges, coalesce(s, 0) silver_badges, coalesce(b, 0) bronze_badges
        from customer left join (
            select o_custkey,
                   count(*) filter (where o_orderpriority like '1%') g,
                   count(*) filter (where o_orderpriority like '2%') s,
                   count(*) filter (where o_orderpriority like '3%') b
            from orders group by o_custkey) o on o_custkey = c_custkey""",
    "qa_answers": """
        select {hash_1} * 2147483648 + {hash_2} answer_id,
               l_orderkey question_id, l_partkey user_id, l_quantity - 25 score, l_returnflag = 'A' is_accepted
        from lineitem""".format(hash_1=_line_hash_sql(48271), hash_2=_line_hash_sql(69621)),
    "qa_questions": """
        select o_orderkey question_id, o_custkey user_id, o_totalprice score, accepted_answer_id
        from orders left join (
            select question_id q, min(answer_id) accepted_answer_id
            from qa_answers where is_accepted group by question_id) a on q = o_orderkey""",
    "forum_posts": """
        select cast(o_orderkey as varchar) post_id, 'u' || cast(o_custkey as varchar) author,
               floor(o_totalprice) score, coalesce(n, 0) num_comments
        from orders left join (
            select l_orderkey, count(*) n from lineitem group by l_orderkey) l on l_orderkey = o_orderkey""",
    "forum_comments": """
        select answer_id comment_id, 't3_' || cast(question_id as varchar) post_id,
               'u' || cast(user_id as varchar) author, score
        from qa_answers""",
    "predictions": """
        select event_id as key, value / 500 prob, cast(value / 500 >= 0.5 as int) pred,
               cast(event_type = 'purchase' as int) as label,
               0.5 - value / 500 z0, value / 500 - 0.5 z1,
               event_id // 64 batch_id, cast((event_id // 64) % 5 as int) epoch
        from events""",
}
NEEDS = {"qa_questions": ["qa_answers"], "forum_comments": ["qa_answers"]}
