import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from agora.catalog import FORUM, QA, Profile, edge_types, index_of, node_id, type_of
from agora.operators import graph_build, graph_ops, neighbors, ordering
from agora.operators.skew import bucketed_join, salted_join
from agora.session import materialize
from agora.sources import graph_store
from tests.conftest import rows

EDGES = "src_type string, relation string, dst_type string, src bigint, dst bigint"


@pytest.fixture(scope="module")
def qa(spark):
    users = spark.createDataFrame([(30, "c", 1), (10, "a", 0), (20, "b", 0)], "user_id bigint, display_name string, influential int")
    questions = spark.createDataFrame(
        [(5, 10, 1.0, "12.0"), (6, 10, 2.0, None), (7, 99, 3.0, "77"), (8, None, 4.0, "11")],
        "question_id bigint, user_id bigint, score double, accepted_answer_id string",
    )
    answers = spark.createDataFrame(
        [(11, 5, 20, 1.0), (12, 5, None, 2.0), (13, 404, 30, 3.0), (12, 6, 20, 9.0)],
        "answer_id bigint, question_id bigint, user_id bigint, score double",
    )
    return graph_build.qa_graph(users, questions, answers)


def test_catalogue_has_all_relations():
    assert (len(edge_types(QA)), len(edge_types(FORUM))) == (9, 7)
    assert ("answer", "rev_accepted", "question") in edge_types(QA)
    assert ("comment", "has_comment__reverse", "post") in edge_types(FORUM)


def test_qa_nodes_are_dense_and_repeats_merge(qa):
    found = rows(qa.nodes, "node_type", "key", "idx", "x", "y")
    assert found == [
        ("answer", "11", 0, [1.0], None),
        ("answer", "12", 1, [9.0], None),
        ("answer", "13", 2, [3.0], None),
        ("question", "5", 0, [1.0], None),
        ("question", "6", 1, [2.0], None),
        ("question", "7", 2, [3.0], None),
        ("question", "8", 3, [4.0], None),
        ("user", "10", 0, [1.0], 0),
        ("user", "20", 1, [1.0], 0),
        ("user", "30", 2, [1.0], 1),
    ]


def test_qa_edges_drop_unknown_ends(qa):
    assert rows(qa.edges, "relation", "src", "dst") == sorted(
        [
            ("asks", 0, 0),
            ("asks", 0, 1),
            ("accepted_answer", 0, 1),
            ("accepted_answer", 3, 0),
            ("answers", 1, 0),
            ("answers", 2, 2),
            ("answers", 1, 1),
            ("has", 0, 0),
            ("has", 0, 1),
            ("has", 1, 1),
        ],
        key=repr,
    )


def test_last_row_wins_by_row_order(spark):
    posts = spark.createDataFrame([("p", "1", 1), ("p", "7", 3), ("p", "9", 2), ("q", "abc", 4)], "post_id string, score string, n int")
    assert rows(graph_build.distinct_posts(posts, "n")) == [("p", 7.0), ("q", 0.0)]


def test_forum_graph_rules(spark):
    posts = spark.createDataFrame(
        [("zoe", "at3_b", "2", 1, 0), ("amy", "p2", "abc", 0, 1), ("zoe", "ab", "3", 0, 2)],
        "author string, post_id string, score string, active int, n bigint",
    )
    comments = spark.createDataFrame(
        [(1, "t3_at3_b", "bob", "1", 1, 0), (2, "t3_p2", "amy", "2", 0, 1), (3, "t3_gone", "zoe", None, 1, 2)],
        "comment_id bigint, post_id string, author string, score string, active int, n bigint",
    )
    natural = graph_build.forum_graph(posts, comments)
    authors = natural.nodes.where("node_type = 'author'")
    assert rows(authors, "key", "idx", "x", "y") == [("amy", 0, [0.0], 0), ("bob", 1, [1.0], 0), ("zoe", 2, [2.0], 1)]
    # Every "t3_" goes: the first comment reaches post "ab", not post "at3_b".
    index = {(r.node_type, r.key): r.idx for r in natural.nodes.collect()}
    linked = rows(natural.edges.where("relation = 'has_comment'"), "src", "dst")
    assert linked == sorted([(index["post", "ab"], 0), (index["post", "p2"], 1)])
    assert natural.edges.where("relation = 'wrote_post'").count() == 3
    assert natural.edges.where("relation = 'wrote_comment'").count() == 3
    seen = graph_build.forum_nodes(posts, comments, row_order="n").where("node_type = 'author'")
    assert rows(seen, "key", "idx") == [("amy", 1), ("bob", 2), ("zoe", 0)]
    everything = graph_build.forum_nodes(posts, comments, label_scope="all").where("node_type = 'author'")
    assert rows(everything, "key", "y") == [("amy", 0), ("bob", 1), ("zoe", 1)]
    with pytest.raises(ValueError):
        graph_build.author_labels(posts, comments, "none")


def test_reverse_twice_is_the_original(qa):
    once = graph_ops.reverse_edges(qa.edges, Profile(QA))
    assert once.count() == 2 * qa.edges.count()
    added = once.where(F.col("relation").startswith("rev_"))
    back = added.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    assert rows(back) == rows(qa.edges, "src", "dst")
    again = graph_ops.reverse_edges(qa.edges.unionByName(added.where("relation = 'rev_asks'")), Profile(QA))
    assert again.where("relation = 'rev_asks'").count() == 2


def test_relation_without_edges(spark, qa):
    none = qa.edges.where("relation = 'nothing'")
    assert graph_ops.reverse_edges(none, Profile(QA)).count() == 0
    loops = graph_ops.self_loops(qa.nodes, "user")
    assert rows(loops, "src", "dst") == [(0, 0), (1, 1), (2, 2)]


def test_validation_names_foreign_relations(spark, qa):
    strange = spark.createDataFrame([("user", "likes", "user", 0, 1)], EDGES)
    with pytest.raises(ValueError, match="likes"):
        graph_ops.validate(qa.with_edges(strange))
    assert rows(graph_ops.catalogue_check(strange, Profile(QA)), "relation", "edges", "known") == [("likes", 1, False)]


def test_node_numbers(spark):
    df = spark.createDataFrame([("user", 0), ("comment", 2**40)], "t string, i bigint").withColumn("n", node_id("t", "i"))
    assert rows(df.select(type_of("n"), index_of("n"))) == rows(df, "t", "i")
    with pytest.raises(Exception, match="unknown node type"):
        spark.createDataFrame([("robot", 1)], "t string, i bigint").select(node_id("t", "i")).collect()


@pytest.fixture(scope="module")
def ring(spark):
    """A cycle of users 0-1-2-3-0 with a parallel edge, a branch, and a lone node 9."""
    pairs = [(0, 1), (0, 1), (1, 2), (2, 3), (3, 0), (1, 4)]
    return spark.createDataFrame([("user", "asks", "user", s, d) for s, d in pairs], EDGES)


def test_ego_graph_grows_and_keeps_parallel_edges(spark, ring):
    seeds = spark.createDataFrame([(7, "user", 0), (8, "user", 9)], "seed_id bigint, node_type string, idx bigint")
    before = set()
    for radius, want in enumerate([{0}, {0, 1}, {0, 1, 2, 4}, {0, 1, 2, 3, 4}]):
        nodes = graph_ops.ego_nodes(ring, seeds, radius)
        found = {r.idx for r in nodes.where("seed_id = 7").collect()}
        assert found == want and before <= found
        before = found
        assert rows(nodes.where("seed_id = 8"), "idx", "hops") == [(9, 0)]
    nodes, edges = graph_ops.ego_graph(ring, seeds, 2)
    assert rows(edges, "seed_id", "src", "dst") == [(7, 0, 1), (7, 0, 1), (7, 1, 2), (7, 1, 4)]


def test_induced_edges_need_both_ends(spark, ring):
    members = spark.createDataFrame([("user", 0), ("user", 1), ("user", 3), ("question", 2)], "node_type string, idx bigint")
    assert rows(graph_ops.induced_edges(ring, members), "src", "dst") == [(0, 1), (0, 1), (3, 0)]


def test_hub_is_capped_in_every_relation(spark):
    hub = spark.range(200).select(
        F.lit("user").alias("src_type"),
        F.when(F.col("id") < 150, "asks").otherwise("has").alias("relation"),
        F.lit("question").alias("dst_type"),
        F.col("id").alias("src"),
        (F.col("id") % 100 == 99).cast("bigint").alias("dst"),
    )
    capped = neighbors.cap_in_edges(hub, 5)
    counts = {(r.relation, r.dst): r["count"] for r in capped.groupBy("relation", "dst").count().collect()}
    assert counts == {("asks", 0): 5, ("asks", 1): 1, ("has", 0): 5, ("has", 1): 1}
    assert rows(capped) == rows(neighbors.cap_in_edges(hub.repartition(7), 5))
    assert rows(capped) != rows(neighbors.cap_in_edges(hub, 5, seed=1))
    assert "WindowGroupLimit" in capped._jdf.queryExecution().executedPlan().toString()


def test_sampled_hops_expand_each_node_once(spark, ring):
    seeds = spark.createDataFrame([(0, "user", 0), (1, "user", 1)], "batch_id int, node_type string, idx bigint")
    nodes, edges = neighbors.neighbor_sample(ring, seeds, (10, 10))
    assert rows(nodes) == [(0, "user", 0, 0), (0, "user", 2, 2), (0, "user", 3, 1), (1, "user", 0, 1), (1, "user", 1, 0), (1, "user", 3, 2)]
    assert rows(edges, "batch_id", "hop", "src", "dst") == [(0, 1, 3, 0), (0, 2, 2, 3), (1, 1, 0, 1), (1, 1, 0, 1), (1, 2, 3, 0)]


def test_graph_store_prunes_partitions(spark, qa, tmp_path):
    path = str(tmp_path / "graph")
    graph_store.write_graph(qa, path)
    whole = graph_store.read_graph(spark, path, QA)
    assert rows(whole.nodes, "node_type", "key", "idx", "x", "y") == rows(qa.nodes, "node_type", "key", "idx", "x", "y")
    part = graph_store.read_graph(spark, path, QA, relations=["asks"]).edges
    assert rows(part, "src", "dst") == [(0, 0), (0, 1)]
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(relation" in plan or "relation#" in plan.split("PartitionFilters")[1][:60]


def test_multigraph_view_and_degrees(qa):
    assert graph_ops.multigraph_view(qa).count() == qa.nodes.count() + qa.edges.count()
    degrees = {r.relation: (r.edges, r.sources, r.max_out_degree, r.destinations, r.max_in_degree) for r in graph_ops.degree_summary(qa.edges).collect()}
    assert degrees["asks"] == (2, 1, 2, 2, 1)
    assert degrees["has"] == (3, 2, 2, 2, 2)


def draws_by_hand(seed, k, degree, *keys):
    """Floyd's method with the md5 of seed, keys and j."""
    taken = []
    for j in range(max(degree - k, 0), degree):
        digest = hashlib.md5("|".join(map(str, (seed, *keys, j))).encode()).hexdigest()
        t = int(digest[:15], 16) % (j + 1)
        taken.append(j if t in taken else t)
    return taken


def star(spark, leaves):
    return spark.range(leaves).select(
        F.lit("user").alias("src_type"), F.lit("asks").alias("relation"), F.lit("question").alias("dst_type"),
        F.col("id").alias("src"), F.lit(0).cast("bigint").alias("dst"),
    )


def test_batches_draw_for_themselves_and_uniformly(spark):
    batches = 3000
    seeds = spark.range(batches).select(F.col("id").cast("int").alias("batch_id"), F.lit("question").alias("node_type"), F.lit(0).cast("bigint").alias("idx"))
    index = neighbors.adjacency(star(spark, 10))
    _, taken = neighbors.neighbor_sample(index, seeds, (3,), 5)
    found = {}
    for r in taken.collect():
        found.setdefault(r.batch_id, []).append(r.src)
    assert all(len(set(f)) == 3 for f in found.values()) and len(found) == batches
    assert all(sorted(found[b]) == sorted(draws_by_hand(5, 3, 10, b, "asks", 0)) for b in range(batches))
    sets = Counter(frozenset(f) for f in found.values())
    # 120 sets of 3, 25 times each on average; the statistic's mean is 119, its deviation 15.4.
    assert len(sets) == 120 and sum((n - 25) ** 2 / 25 for n in sets.values()) < 119 + 5 * 15.4
    again = neighbors.neighbor_sample(index, seeds, (3,), 6)[1]
    assert rows(again, "batch_id", "src") != rows(taken, "batch_id", "src")


def test_a_draw_reads_few_blocks_of_a_hub(spark):
    hub = star(spark, 50 * neighbors.BLOCK)
    seeds = spark.createDataFrame([(0, "question", 0)], "batch_id int, node_type string, idx bigint")
    index = neighbors.adjacency(hub.unionByName(hub.where("src = 7")))  # with a parallel edge
    assert index.blocks.count() == 51 and index.degrees.first().degree == 50 * neighbors.BLOCK + 1
    _, taken = neighbors.neighbor_sample(index, seeds, (4,), 1)
    want = [p if p <= 7 else p - 1 for p in draws_by_hand(1, 4, 50 * neighbors.BLOCK + 1, 0, "asks", 0)]
    assert sorted(r.src for r in taken.collect()) == sorted(want)
    for path in ("_dst", "number"):
        assert path not in index.blocks.columns


def test_adjacency_holds_what_draws_can_ask_for(spark):
    """Two hops from one node of a long chain: the edges into it and into what leads to it, drawn as from all edges."""
    chain = spark.range(1000).select(
        F.lit("user").alias("src_type"), F.lit("knows").alias("relation"), F.lit("user").alias("dst_type"),
        (F.col("id") + 1).alias("src"), F.col("id").alias("dst"),
    )
    edges = chain.unionByName(chain).unionByName(chain.withColumn("src", F.col("src") + 1))  # with parallel edges
    seeds = spark.createDataFrame([(0, "user", 5), (1, "user", None)], "batch_id int, node_type string, idx bigint")
    index = neighbors.adjacency(edges, seeds, 2)
    assert sorted(r["_dst"] & 0xFFFF for r in index.degrees.collect()) == [5, 6, 7]
    assert index.degrees.agg(F.sum("degree")).first()[0] == 9
    whole = neighbors.neighbor_sample(neighbors.adjacency(edges), seeds, (2, 2), 3)
    for found, want in zip(neighbors.neighbor_sample(index, seeds, (2, 2), 3), whole):
        assert rows(found) == rows(want)


def test_ego_graphs_of_many_seeds(spark):
    """2,500 seeds, three blocks of bits, on a random graph with a hub; two nodes for some seeds."""
    rng = random.Random(9)
    pairs = [(rng.randrange(400), rng.randrange(400)) for _ in range(500)] + [(399, k) for k in range(0, 400, 3)] + [(5, 399)] * 2
    edges = spark.createDataFrame([("user", "asks", "user", s, d) for s, d in pairs], EDGES)
    starts = {7 * k - 3: [k % 400] + ([(k * 7) % 400] if k % 5 == 0 else []) for k in range(2500)}
    seeds = spark.createDataFrame([(i, "user", n) for i, own in starts.items() for n in own], "seed_id bigint, node_type string, idx bigint")
    after = {}
    for s, d in pairs:
        after.setdefault(s, set()).add(d)
    want = set()
    for i, own in starts.items():
        reached = dict.fromkeys(own, 0)
        frontier = set(own)
        for hop in (1, 2):
            frontier = {d for s in frontier for d in after.get(s, ())} - reached.keys()
            reached |= dict.fromkeys(frontier, hop)
        want |= {(i, "user", n, h) for n, h in reached.items()}
    nodes, inside = graph_ops.ego_graph(edges, seeds, 2)
    assert {tuple(r) for r in nodes.collect()} == want
    members = {}
    for i, _, n, _ in want:
        members.setdefault(n, set()).add(i)
    counts = Counter((s, d) for s, d in pairs for _ in members.get(s, set()) & members.get(d, set()))
    assert Counter({(r.src, r.dst): r["count"] for r in inside.groupBy("src", "dst").count().collect()}) == counts
    # What a round stores is bounded by the nodes for each block of 1,024 seeds.
    numbered, _, words = graph_ops._numbered(seeds)
    stored = graph_ops._search(graph_ops._with_ends(edges), numbered, 2, words, [])
    assert words == graph_ops.WORDS and stored.where("hops = 2").count() <= 3 * 400


def test_stored_graph_joins_without_moving_edges(spark, qa, tmp_path):
    path = str(tmp_path / "stored")
    graph_store.write_bucketed(qa, path, "stored_test", 4)
    seeds = qa.nodes.where("node_type = 'user'").select(F.col("idx").alias("seed_id"), "node_type", "idx")
    want_nodes, want_edges = (rows(f) for f in graph_ops.ego_graph(qa.edges, seeds, 2))
    stored = graph_store.open_bucketed(spark, path, "stored_test", QA)
    # A session that doesn't know the tables registers them from the files.
    other = graph_store.open_bucketed(spark.newSession(), path, "stored_again", QA)
    assert rows(other.out_edges.frame, "relation", "src", "dst") == rows(qa.edges, "relation", "src", "dst")
    for graph in (stored, other):
        assert rows(graph_ops.ego_nodes(graph.out_edges, seeds, 2)) == want_nodes
    assert rows(graph_ops.ego_graph(stored.out_edges, seeds, 2)[1]) == want_edges
    for edges, key in ((stored.out_edges, "_src"), (stored.in_edges, "_dst")):
        step = seeds.select(node_id("node_type", "idx").alias(key), "seed_id")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        try:
            hop = bucketed_join(edges, step, ["src", "dst", key])
            plan = hop._jdf.queryExecution().executedPlan().toString()
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        # The one exchange is that of the step.
        assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
        assert rows(hop, "seed_id", "src", "dst") == rows(salted_join(edges.frame, step, key), "seed_id", "src", "dst")


def test_in_edges_of_a_prepared_graph_are_its_out_edges_the_other_way_round(spark, qa, tmp_path):
    """The second edge table is written without a shuffle, a file for each bucket; other graphs shuffle it."""
    ready = graph_ops.prepare(qa)
    assert not ready.with_edges(ready.edges).mirrors and not graph_ops.prepare(ready).mirrors
    for name, graph in (("mirrored", ready), ("plain", qa), ("cut", ready.with_edges(ready.edges.where("relation <> 'rev_has'")))):
        path = str(tmp_path / name)
        exchanged = []
        run = type(spark.range(1).write).saveAsTable
        with pytest.MonkeyPatch.context() as patch:

            def spied(writer, table):
                plan = writer._df._jdf.queryExecution().executedPlan().toString()
                exchanged.append("Exchange" in plan)
                return run(writer, table)

            patch.setattr(type(spark.range(1).write), "saveAsTable", spied)
            graph_store.write_bucketed(graph, path, f"{name}_test", 4)
        assert exchanged == [True, True, name != "mirrored"]
        stored = graph_store.open_bucketed(spark, path, f"{name}_test", QA)
        for part in (stored.out_edges, stored.in_edges):
            assert part.frame.columns == [*graph_ops.EDGE_KEYS, "src", "dst", "_src", "_dst"]
            assert rows(part.frame.drop("_src", "_dst")) == rows(graph.edges.select(*graph_ops.EDGE_KEYS, "src", "dst"))
        assert rows(stored.nodes.frame.drop("_node")) == rows(graph.nodes)
        files = [p.name.split("_")[-1] for p in (tmp_path / name / "in_edges").glob("part-*")]
        assert len(files) == len(set(files))


def test_stored_keys_keep_their_text(spark, tmp_path):
    keys = ["7", "07", "+7", " 7", "-3", "x", "", None, "9223372036854775808", "9223372036854775807"]
    nodes = spark.createDataFrame([("user", k, i, [float(i)], None, None) for i, k in enumerate(keys)], graph_build.NODE_SCHEMA)
    edges = spark.createDataFrame([("user", "asks", "question", 0, 1)], EDGES)
    graph_store.write_bucketed(graph_build.Graph(Profile(QA), nodes, edges), str(tmp_path / "keys"), "keys_test", 2)
    stored = graph_store.open_bucketed(spark, str(tmp_path / "keys"), "keys_test", QA)
    assert {(r.idx, r.key) for r in stored.nodes.frame.collect()} == set(enumerate(keys))


def test_heavy_buckets_are_spread(spark, tmp_path):
    pairs = [("user", "asks", "question", 0, k) for k in range(20_000)] + [("user", "asks", "question", k, k) for k in range(1, 300)]
    edges = spark.createDataFrame(pairs, EDGES)
    nodes = spark.createDataFrame([("user", "0", 0, [1.0], 1, None)], graph_build.NODE_SCHEMA)
    graph_store.write_bucketed(graph_build.Graph(Profile(QA), nodes, edges), str(tmp_path / "hub"), "hub_test", 4)
    stored = graph_store.open_bucketed(spark, str(tmp_path / "hub"), "hub_test", QA)
    hub = stored.out_edges.frame.where("src = 0").first()["_src"]
    assert stored.out_edges.hot == [hub] and stored.in_edges.hot == []
    step = spark.createDataFrame([(hub, 1), (hub + 5, 2)], "_src bigint, seed_id int")
    met = bucketed_join(stored.out_edges, step, ["_src", "dst"])
    assert {(r.seed_id, r["count"]) for r in met.groupBy("seed_id").count().collect()} == {(1, 20_000), (2, 1)}


def test_whole_keys_travel_as_numbers(spark):
    """No text of a numeric key is shuffled, and a number meets only the usual spelling of it."""
    questions = spark.createDataFrame([(5, 7, 1.0, "11"), (6, 8, 2.0, None)], "question_id bigint, user_id int, score double, accepted_answer_id string")
    answers = spark.createDataFrame([(11, 5, 7, 1.0)], "answer_id bigint, question_id bigint, user_id bigint, score double")
    users = spark.createDataFrame([("07", 1), ("7", 0), ("x", 0)], "user_id string, influential int")
    typed = graph_build._typed(questions, "question", "question_id", F.col("score"))
    assert rows(typed, "key", "place") == [(None, 5), (None, 6)]
    graph = graph_build.qa_graph(users, questions, answers)
    index = {(r.node_type, r.key): r.idx for r in graph.nodes.collect()}
    assert set(index) == {("user", "07"), ("user", "7"), ("user", "x"), ("question", "5"), ("question", "6"), ("answer", "11")}
    seven = index["user", "7"]
    assert rows(graph.edges, "relation", "src", "dst") == [
        ("accepted_answer", 0, 0), ("answers", seven, 0), ("asks", seven, 0), ("has", 0, 0)
    ]


def test_rows_move_once_to_become_nodes(spark, monkeypatch):
    """The order by key also brings repeats together: nothing is grouped by a shuffle of its own before."""
    plans = []

    def seen(df, label):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return materialize(df, label)

    monkeypatch.setattr(ordering, "materialize", seen)
    users = spark.createDataFrame([("a", 1), ("a", 0)], "user_id string, influential int")
    questions = spark.createDataFrame([(5, "a", 1.0, None)], "question_id bigint, user_id string, score double, accepted_answer_id string")
    answers = spark.createDataFrame([(7, 5, "a", 2.0), (7, 5, "b", 1.0)], "answer_id bigint, question_id bigint, user_id string, score double")
    nodes = graph_build.qa_nodes(users, questions, answers)
    assert rows(nodes, "node_type", "key", "x", "y") == [("answer", "7", [2.0], None), ("question", "5", [1.0], None), ("user", "a", [1.0], 1)]
    assert plans and all("rangepartitioning" in p and "hashpartitioning" not in p for p in plans)


@pytest.mark.parametrize("few, heavy", [(100, False), (0, False), (100, True), (0, True)])
def test_rows_of_repeated_keys_keep_their_own_edges(spark, monkeypatch, few, heavy):
    monkeypatch.setattr(graph_build, "FEW", few)
    if heavy:
        monkeypatch.setattr(graph_build, "heavy_keys", lambda df, columns: {c: [7] if c == "key" else [] for c in columns})
    users = spark.createDataFrame([(1, 0), (2, 0)], "user_id bigint, influential int")
    questions = spark.createDataFrame([(5, 1, 1.0, "7"), (6, None, 1.0, "8")], "question_id bigint, user_id bigint, score double, accepted_answer_id string")
    answers = spark.createDataFrame(
        [(7, 5, 1, 1.0), (7, 6, None, 3.0), (7, 6, 2, None), (8, 6, 2, 4.0), (9, None, 1, 5.0), (None, 5, 1, 6.0)],
        "answer_id bigint, question_id bigint, user_id bigint, score double",
    )
    graph = graph_build.qa_graph(users, questions, answers)
    assert rows(graph.nodes.where("node_type = 'answer'"), "key", "idx", "x") == [("7", 0, [3.0]), ("8", 1, [4.0]), ("9", 2, [5.0])]
    assert rows(graph.edges, "relation", "src", "dst") == sorted(
        [("accepted_answer", 0, 0), ("accepted_answer", 1, 1), ("asks", 0, 0), ("answers", 0, 0), ("answers", 1, 0), ("answers", 1, 1), ("answers", 0, 2)]
        + [("has", 0, 0), ("has", 1, 0), ("has", 1, 0), ("has", 1, 1)]
    )


def test_seeds_at_nodes_of_their_own_have_narrow_blocks(spark):
    seeds = spark.range(2000).select(F.col("id").alias("seed_id"), F.lit("user").alias("node_type"), F.col("id").alias("idx"))
    assert graph_ops._numbered(seeds)[2] == 1
    assert graph_ops._numbered(seeds.withColumn("idx", F.col("idx") % 10))[2] == graph_ops.WORDS
    edges = spark.range(2000).select(*[F.lit(v).alias(c) for c, v in zip(("src_type", "relation", "dst_type"), ("user", "asks", "question"))], F.col("id").alias("src"), F.expr("id div 2").alias("dst"))
    found = graph_ops.ego_nodes(edges, seeds, 1)
    assert found.count() == 4000 and found.where("hops = 1 and idx = seed_id div 2").count() == 2000


def test_buckets_grow_with_the_edges(spark, qa, tmp_path, monkeypatch):
    monkeypatch.setattr(graph_store, "BUCKET_ROWS", 2)
    graph_store.write_bucketed(qa, str(tmp_path / "grown"), "grown_test", 4)
    stored = graph_store.open_bucketed(spark, str(tmp_path / "grown"), "grown_test", QA)
    assert stored.out_edges.buckets == 5 and stored.out_edges.frame.count() == 10
