import random
from pathlib import Path
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from agora.operators import sampling
from agora.operators.neighbors import stratified_batches
from agora.operators.ordering import dense_index, index_rows, running_totals
from agora.operators.skew import heavy_keys, salted_join
from agora.session import materialize, scratch_path
from tests.conftest import rows


@pytest.fixture(scope="module")
def letters(spark):
    rng = random.Random(3)
    data = [(rng.choice("xy"), rng.randrange(10**6), i) for i in range(400)]
    return data, spark.createDataFrame(data, "g string, v bigint, i bigint").repartition(5)


@pytest.mark.parametrize("partitions", [1, 3, 7])
def test_dense_index_over_partitions(letters, partitions):
    data, df = letters
    want = {row[2]: place for place, row in enumerate(sorted(data, key=lambda r: (r[1], r[2])))}
    found = dense_index(df, ["v", "i"], partitions=partitions)
    assert {r.i: r.idx for r in found.collect()} == want


@pytest.mark.parametrize("partitions", [1, 7])
def test_dense_index_restarts_in_groups(letters, partitions):
    data, df = letters
    indexed = index_rows(df, ["v", "i"], within=["g"], partitions=partitions)
    for group in "xy":
        own = sorted((r for r in data if r[0] == group), key=lambda r: (r[1], r[2]))
        assert indexed.totals[(group,)] == len(own)
        found = {r.i: r.idx for r in indexed.frame.where(F.col("g") == group).collect()}
        assert found == {row[2]: place for place, row in enumerate(own)}


def test_equal_rows_are_spread_and_still_numbered(spark):
    df = spark.range(1000).select(F.when(F.col("id") % 3 > 0, "same").otherwise("other").alias("k"))
    found = dense_index(df, ["k"], spread_ties=True, partitions=6)
    assert sorted(r.idx for r in found.collect()) == list(range(1000))
    assert found.where("k = 'other'").agg(F.max("idx")).first()[0] == 333


@pytest.mark.parametrize("partitions", [1, 6])
def test_running_totals_and_next_values(letters, partitions):
    data, df = letters
    found = running_totals(df, ["i"], {"total": "v"}, {"after": "v"}, partitions=partitions)
    got = {r.i: (r.total, r.after) for r in found.collect()}
    total = 0
    for place, row in enumerate(data):
        total += row[1]
        after = data[place + 1][1] if place + 1 < len(data) else None
        assert got[row[2]] == (total, after)


def test_exact_sample_and_refined_histogram(spark, monkeypatch):
    df = spark.range(500).withColumnRenamed("id", "k")
    plain = rows(sampling.sample_exact(df, 123, "k", 7))
    assert len(plain) == 123
    monkeypatch.setattr(sampling, "_MAX_BUCKET", 0)
    monkeypatch.setattr(sampling, "_DIGITS", 1)
    assert rows(sampling.sample_exact(df.repartition(9), 123, "k", 7)) == plain
    assert sampling.sample_exact(df, 500, "k").count() == 500
    with pytest.raises(ValueError):
        sampling.sample_exact(df, 501, "k")


def test_repeated_keys_are_sampled_exactly_but_not_split(spark):
    df = spark.createDataFrame([(1, v) for v in range(6)] + [(2, 9)] * 4, "k int, v int")
    for n in range(11):
        assert sampling.sample_exact(df, n, "k").count() == n
    assert rows(sampling.sample_exact(df, 3, "k")) == rows(sampling.sample_exact(df.repartition(6), 3, "k"))
    with pytest.raises(ValueError):
        sampling.train_test_split(df, "k")


def test_first_rows(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(10)], "k int, v int")
    assert rows(sampling.take_first(df, 4, ["v", "k"])) == [(0, 0), (3, 0), (6, 0), (9, 0)]
    with pytest.raises(ValueError):
        sampling.take_first(df, 11, ["k"])


def test_splits_are_exact_and_stable(spark):
    df = spark.range(101).withColumnRenamed("id", "k")
    once = rows(sampling.train_test_split(df, "k"))
    assert once == rows(sampling.train_test_split(df.repartition(7), "k"))
    assert [s for _, s in once].count("test") == 21
    nodes = df.select(F.lit("user").alias("node_type"), F.col("k").cast("string").alias("key"), F.col("k").alias("idx"))
    nodes = nodes.unionByName(nodes.withColumn("node_type", F.lit("question")))
    counts = {(r.node_type, r.split): r["count"] for r in sampling.node_split(nodes, "user").groupBy("node_type", "split").count().collect()}
    assert counts == {("user", "val"): 10, ("user", "test"): 10, ("user", "train"): 81, ("question", None): 101}
    assert sampling.pick_seeds(nodes, "user", count=200).count() == 101
    assert rows(sampling.pick_seeds(nodes, "user", idx=5), "idx") == [(5,)]
    assert sampling.pick_seeds(nodes, "user", idx=500).count() == 0


def test_batches_hold_every_class_equally(spark):
    df = spark.range(200).select(F.col("id").alias("k"), (F.col("id") % 9 == 0).cast("int").alias("y"))
    batches = stratified_batches(df, "k", "y", batch_size=8)
    counts = {(r.batch_id, r.y): r["count"] for r in batches.groupBy("batch_id", "y").count().collect()}
    assert counts == {(b, y): 4 for b in range(5) for y in (0, 1)}
    assert rows(batches) == rows(stratified_batches(df.repartition(11), "k", "y", batch_size=8))
    with pytest.raises(ValueError):
        stratified_batches(df, "k", "y", batch_size=1)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_salted_join_equals_plain_join(spark, how):
    facts = spark.range(900).select(
        F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 7 == 0, None).otherwise(F.col("id") % 50).alias("k"), "id"
    )
    dim = spark.createDataFrame([(k, k * 10) for k in range(0, 40)] + [(None, -1)], "k bigint, v bigint")
    plain = facts.join(dim, "k", how)
    assert rows(salted_join(facts, dim, "k", how, hot=[1, 4]), *plain.columns) == rows(plain)


def test_heavy_keys_finds_the_hot_value(spark):
    df = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"))
    assert heavy_keys(df, ["k"]) == {"k": [7]}
    both = df.withColumn("t", F.when(F.col("k") == 7, "hot").when(F.col("k") % 2 == 0, None).otherwise(F.col("k").cast("string")))
    assert heavy_keys(both, ["k", "t"]) == {"k": [7], "t": ["hot"]}
    assert heavy_keys(df.limit(50), ["k"]) == {"k": []}


def test_scratch_tables_are_small(spark):
    """A numbered table of keys: its files hold less than two thirds of what snappy makes of them."""
    rows = spark.range(200_000).select(
        F.concat(F.lit("u"), (F.col("id") * 7919 % 20_011).cast("string")).alias("author"), "id", F.col("id").alias("slot")
    ).coalesce(1)
    stored = materialize(rows, "small")
    plain = scratch_path(spark, "snappy")
    rows.write.parquet(plain, compression="snappy")

    def size(paths):
        return sum(Path(urlparse(p).path).stat().st_size for p in paths)

    assert 3 * size(stored.inputFiles()) < 2 * size(spark.read.parquet(plain).inputFiles())
    assert stored.dtypes == rows.dtypes and stored.exceptAll(rows).isEmpty() and stored.count() == 200_000
