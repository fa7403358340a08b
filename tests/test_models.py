from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from agora.catalog import QA, Profile
from agora.config import GRAPH_SETS, TREE_SETS, GraphSet, tree_set
from agora.operators import sage, sage_kernel, sage_train, trees, vectors
from agora.operators.graph_build import EDGE_SCHEMA, NODE_SCHEMA, Graph
from agora.operators.graph_ops import prepare
from agora.session import materialize
from agora.sources import artifacts

PROFILE = Profile(QA)


@pytest.fixture(scope="module")
def small(spark):
    """Users who ask high-scored questions are positive; every third user also answers."""
    rng = np.random.default_rng(0)
    users, questions = 60, 120
    y = (np.arange(users) % 3 == 0).astype(int)
    owner = rng.integers(0, users, questions)
    nodes = [("user", str(i), i, [1.0], int(y[i]), None) for i in range(users)]
    nodes += [("question", str(i), i, [float(rng.normal(3 * y[owner[i]], 0.5))], None, None) for i in range(questions)]
    nodes += [("answer", str(i), i, [float(rng.normal())], None, None) for i in range(80)]
    edges = [("user", "asks", "question", int(owner[i]), i) for i in range(questions)]
    edges += [("question", "has", "answer", int(rng.integers(0, questions)), i) for i in range(80)]
    edges += [("user", "answers", "answer", int(rng.integers(0, users)), i) for i in range(0, 80, 2)]
    edges += [("question", "has", "answer", 0, 0)]
    graph = Graph(PROFILE, spark.createDataFrame(nodes, NODE_SCHEMA), spark.createDataFrame(edges, EDGE_SCHEMA))
    return prepare(graph)


def whole_subgraph(graph):
    nodes = graph.nodes.collect()
    x = {}
    for t in PROFILE.node_types:
        own = sorted((n.idx, n.x) for n in nodes if n.node_type == t)
        x[t] = np.array([v for _, v in own])
    y = np.array([n.y for n in sorted((n for n in nodes if n.node_type == "user"), key=lambda n: n.idx)])
    edges = {r: ([], []) for _, r, _ in PROFILE.edge_types}
    for e in graph.edges.collect():
        edges[e.relation][0].append(e.src)
        edges[e.relation][1].append(e.dst)
    edges = {r: (np.array(s, dtype=int), np.array(d, dtype=int)) for r, (s, d) in edges.items()}
    return sage_kernel.Subgraph(x, y, np.ones(len(y), dtype=bool), edges)


def test_distributed_forward_equals_the_kernel(small):
    params = sage.init_parameters(sage.parameter_shapes(PROFILE, 1, 5, 2), 3)
    want, _ = sage_kernel.logits(params, PROFILE, whole_subgraph(small))
    found = {r.idx: (r.z0, r.z1) for r in sage.forward(small, params).collect()}
    assert len(found) == 60
    for idx, z in found.items():
        assert np.allclose(z, want[idx], atol=1e-9)
    split = sage.predict(small, params, "test").collect()
    assert len(split) == 6
    assert all(np.allclose((r.z0, r.z1), want[r.idx]) for r in split)


@pytest.mark.parametrize("rows", [7, 10_000])
def test_wide_layer_equals_the_kernel(spark, small, rows):
    """Width 64 with nodes whose rows lie in many Arrow batches."""
    params = sage.init_parameters(sage.parameter_shapes(PROFILE, 1, 64, 2), 8)
    want, _ = sage_kernel.logits(params, PROFILE, whole_subgraph(small))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
    try:
        found = {r.idx: (r.z0, r.z1) for r in sage.forward(small, params).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(found) == 60 and all(np.allclose(z, want[idx], atol=1e-9) for idx, z in found.items())


def test_means_travel_narrow_and_hubs_as_sums(small, monkeypatch):
    """Between the layers of width 64 a row has the four means of a node; those of hubs are added up before they travel."""
    params = sage.init_parameters(sage.parameter_shapes(PROFILE, 1, 64, 2), 8)
    incoming = {t: PROFILE.incoming(t) for t in PROFILE.node_types}
    means = sage.neighbor_means(small.nodes, small.nodes, small.edges, PROFILE, incoming, [], 1)
    assert means.select(F.max(F.size("x"))).first()[0] == 4
    want, _ = sage_kernel.logits(params, PROFILE, whole_subgraph(small))
    hubs = [sage.ALL_TYPES.index("user") << sage.INDEX_BITS | i for i in range(0, 60, 2)]
    monkeypatch.setattr(sage, "heavy_keys", lambda *_: {"src": [], "dst": hubs})
    found = {r.idx: (r.z0, r.z1) for r in sage.forward(small, params).collect()}
    assert len(found) == 60 and all(np.allclose(z, want[idx], atol=1e-9) for idx, z in found.items())


def test_plan_does_not_grow_with_the_width(small):
    def plan(hidden):
        logits = sage.forward(small, sage.init_parameters(sage.parameter_shapes(PROFILE, 1, hidden, 2), 8))
        return logits._jdf.queryExecution().executedPlan().toString()

    for word in ("partial_", "Exchange", "MapInArrow", "x["):
        assert plan(2).count(word) == plan(64).count(word)
    assert "partial_sum" not in plan(64)


def test_vector_sums():
    rng = np.random.default_rng(2)
    dst, slot, n, x = rng.integers(0, 5, 90), rng.integers(0, 3, 90), rng.integers(1, 4, 90), rng.normal(size=(90, 6))
    keys = sorted({(d, s) for d, s in zip(dst, slot)})
    found = vectors.summed(dst, slot, n, x)
    assert list(zip(found[0], found[1])) == keys
    for (d, s), count, total in zip(keys, *found[2:]):
        own = (dst == d) & (slot == s)
        assert count == n[own].sum() and np.allclose(total, x[own].sum(axis=0))


def test_sampled_inference_with_large_fanout_equals_the_full_one(small):
    params = sage.init_parameters(sage.parameter_shapes(PROFILE, 1, 3, 2), 4)
    settings = GraphSet(hidden=3, learning_rate=0.01, weight_decay=0.0, batch_size=4, fanouts=(500, 500))
    full = {r.idx: r.prob for r in sage.predict(small, params, "test").collect()}
    sampled = {r.idx: r.prob for r in sage_train.predict_sampled(small, params, settings).collect()}
    assert sampled == pytest.approx(full)
    everyone = sage_train.predict_sampled(small, params, settings, loss_scope="sampled")
    # A question has one asker and an answer one author, so two hops lead to no other user.
    assert everyone.count() == len(full)


def test_gradients_against_finite_differences(small):
    rng = np.random.default_rng(1)
    sub = whole_subgraph(small)
    sub.scope = rng.random(len(sub.y)) < 0.6
    params = sage.init_parameters(sage.parameter_shapes(PROFILE, 1, 3, 2), 5)
    _, grads, _ = sage_kernel.loss_and_gradients(params, PROFILE, sub)
    assert set(grads) == set(params)
    for name, value in params.items():
        flat = value.ravel()
        for k in rng.choice(flat.size, min(3, flat.size), replace=False):
            step, start = 1e-6, flat[k]
            sides = []
            for sign in (1, -1):
                flat[k] = start + sign * step
                sides.append(sage_kernel.loss_and_gradients(params, PROFILE, sub)[0])
            flat[k] = start
            assert grads[name].ravel()[k] == pytest.approx((sides[0] - sides[1]) / (2 * step), abs=1e-6)


def test_training_lowers_the_loss_and_artifacts_reload(spark, small, tmp_path):
    settings = GraphSet(hidden=6, learning_rate=0.05, weight_decay=1e-5, epochs=5, batch_size=16, fanouts=(5, 5))
    trained = sage_train.train_sage(small, settings, batches_per_step=1)
    history = [r.loss for r in trained.metrics.orderBy("epoch").collect()]
    assert len(history) == 5 and history[-1] < history[0]
    artifacts.save_artifacts(trained, str(tmp_path))
    loaded = artifacts.load_weights(spark, str(tmp_path))
    assert all(np.array_equal(loaded[n], w) for n, w in trained.parameters.items())
    assert spark.read.parquet(f"{tmp_path}/train_metrics").count() == 5


def test_training_goes_on_where_it_stopped(spark, small, tmp_path):
    settings = GraphSet(hidden=4, learning_rate=0.05, weight_decay=1e-4, epochs=3, batch_size=8, fanouts=(3, 3))
    whole = sage_train.train_sage(small, settings, batches_per_step=2)
    path = str(tmp_path / "state")
    sage_train.train_sage(small, replace(settings, epochs=1), batches_per_step=2, state_path=path)
    # A write that a lost driver left without its marker doesn't count.
    torn = tmp_path / "state" / "epoch-000002"
    torn.mkdir()
    (torn / "part-00000.parquet").write_bytes(b"half")
    resumed = sage_train.train_sage(small, settings, batches_per_step=2, state_path=path)
    assert all(np.array_equal(resumed.parameters[n], w) for n, w in whole.parameters.items())
    assert resumed.metrics.collect() == whole.metrics.collect()
    # The state of an earlier epoch is still there, and nothing is trained to load it.
    first = sage_train.train_sage(small, replace(settings, epochs=1), batches_per_step=2, state_path=path)
    assert [r.epoch for r in first.metrics.collect()] == [1]
    assert not np.array_equal(first.parameters["head/weight"], whole.parameters["head/weight"])
    for other in (replace(settings, hidden=5), replace(settings, learning_rate=0.1)):
        with pytest.raises(ValueError, match="other settings"):
            sage_train.train_sage(small, other, batches_per_step=2, state_path=path)


def test_one_sequential_step_by_hand(small):
    """All train users of both classes in one batch with all neighbours: gradient by differences, then Adam's formula."""
    settings = GraphSet(hidden=3, learning_rate=0.03, weight_decay=0.02, epochs=1, batch_size=30, fanouts=(500, 500))
    trained = sage_train.train_sage(small, settings, seed=7, batches_per_step=1)
    shapes = sage.parameter_shapes(PROFILE, 1, 3, 2)
    start = sage.init_parameters(shapes, 7)
    users = small.nodes.where("node_type = 'user' and split = 'train'").select("node_type", "idx", "y")
    seeds = [r.idx for r in sage_train.stratified_batches(users, "idx", "y", 30, 7).where("batch_id = 0").collect()]
    sub = whole_subgraph(small)

    def loss(params):
        z, _ = sage_kernel.logits(params, PROFILE, sub)
        return np.mean([np.log(np.exp(z[i]).sum()) - z[i][sub.y[i]] for i in seeds])

    assert trained.metrics.first().loss == pytest.approx(loss(start))
    for name in shapes:
        flat = start[name].ravel()
        for k in range(0, flat.size, 5):
            sides = []
            for move in (1e-6, -1e-6):
                moved = {n: v.copy() for n, v in start.items()}
                moved[name].ravel()[k] += move
                sides.append(loss(moved))
            gradient = (sides[0] - sides[1]) / 2e-6 + settings.weight_decay * flat[k]
            if abs(gradient) > 1e-4:  # the first step of Adam is the rate, in the direction of the gradient
                assert trained.parameters[name].ravel()[k] == pytest.approx(flat[k] - 0.03 * np.sign(gradient), abs=1e-5)


def test_small_steps_share_a_job(spark, small):
    """Nine batches, a step each: one job trains them, as steps one by one do."""
    settings = GraphSet(hidden=3, learning_rate=0.05, weight_decay=1e-4, epochs=1, batch_size=2, fanouts=(2, 2))
    shapes = sage.parameter_shapes(PROFILE, 1, 3, 2)
    users = small.nodes.where("node_type = 'user' and split = 'train'").select("node_type", "idx", "y")
    seeds = sage_train.stratified_batches(users, "idx", "y", 2, 7).select("batch_id", "node_type", "idx").where("batch_id < 9")
    records = sage_train.batch_records(small, seeds, (2, 2), "7/1", 1)
    assert records.select("run").distinct().count() == 1 and records.select("step").distinct().count() == 9
    weights = sage_train.flatten(sage.init_parameters(shapes, 7), list(shapes))
    adam = sage_train.Adam(len(weights), settings.learning_rate, settings.weight_decay)
    found, sums = sage_train._run_result(records, 0, adam, weights, shapes, PROFILE, "seeds")
    plain, total = sage_train.Adam(len(weights), settings.learning_rate, settings.weight_decay), 0.0
    for step in range(9):
        rows = records.where(F.col("batch_id") == step).toArrow()
        sub, _ = sage_train.to_subgraph(rows, PROFILE, "seeds")
        loss, grads, _ = sage_kernel.loss_and_gradients(sage_train.unflatten(weights, shapes), PROFILE, sub)
        weights, total = plain.step(weights, sage_train.flatten(grads, list(shapes))), total + loss
    assert np.array_equal(found, weights) and sums[0] == 9 and sums[1] == pytest.approx(total)
    assert adam.steps == 9 and np.array_equal(adam.second, plain.second)


def test_a_run_gets_one_row_for_a_batch(small):
    """What a task trains step by step was cut out and sorted before, batches side by side."""
    shapes = sage.parameter_shapes(PROFILE, 1, 3, 2)
    users = small.nodes.where("node_type = 'user' and split = 'train'").select("node_type", "idx", "y")
    seeds = sage_train.stratified_batches(users, "idx", "y", 2, 7).select("batch_id", "node_type", "idx").where("batch_id < 5")
    records = sage_train.batch_records(small, seeds, (2, 2), "7/1", 2)
    packed = sage_train.packed_batches(records, PROFILE, "seeds")
    assert sorted((r.batch_id, r.step, r.run) for r in packed.collect()) == [(b, b // 2, 0) for b in range(5)]
    weights = sage_train.flatten(sage.init_parameters(shapes, 7), list(shapes))
    found = []
    for given in (records, packed):
        adam = sage_train.Adam(len(weights), 0.05, 1e-4)
        found.append((*sage_train._run_result(given, 0, adam, weights, shapes, PROFILE, "seeds"), adam.steps))
    assert all(np.array_equal(a, b) for a, b in zip(*found)) and found[0][2] == 3


def test_a_run_is_one_task_that_never_holds_all_batches(spark, small, monkeypatch):
    """Runs are long; their batches pass in small Arrow batches, in their order, with the same bits."""
    assert sage_train._run_steps(4) >= 1000
    shapes = sage.parameter_shapes(PROFILE, 1, 3, 2)
    users = small.nodes.where("node_type = 'user' and split = 'train'").select("node_type", "idx", "y")
    seeds = sage_train.stratified_batches(users, "idx", "y", 2, 7).select("batch_id", "node_type", "idx").where("batch_id < 7")
    packed = materialize(sage_train.packed_batches(sage_train.batch_records(small, seeds, (2, 2), "7/1", 2), PROFILE, "seeds"), "packed")
    weights, run = sage_train.flatten(sage.init_parameters(shapes, 7), list(shapes)), type(packed).mapInArrow

    def small_batches(batches):
        for b in batches:
            assert b.num_rows <= 2
            yield b

    monkeypatch.setattr(type(packed), "mapInArrow", lambda frame, fn, schema: run(frame, lambda b: fn(small_batches(b)), schema))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 2)
    found = []
    try:
        for rows_of_batch in (packed, packed.repartition(5)):
            adam = sage_train.Adam(len(weights), 0.05, 1e-4)
            found.append(sage_train._run_result(rows_of_batch, 0, adam, weights, shapes, PROFILE, "seeds"))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert all(np.array_equal(a, b) for a, b in zip(*found)) and found[0][1][0] == 7


def test_known_means_and_the_first_layer_leave_the_gradients_as_they_are(small):
    shapes = sage.parameter_shapes(PROFILE, 1, 3, 2)
    params = sage.init_parameters(shapes, 7)
    users = small.nodes.where("node_type = 'user' and split = 'train'").select("node_type", "idx", "y")
    seeds = sage_train.stratified_batches(users, "idx", "y", 2, 7).select("batch_id", "node_type", "idx").where("batch_id < 1")
    sub, _ = sage_train.to_subgraph(sage_train.batch_records(small, seeds, (2, 2), "7/1", 1).toArrow(), PROFILE, "seeds")
    plain = sage_kernel.loss_and_gradients(params, PROFILE, sub)
    sub.means = sage_kernel.input_means(PROFILE, sub)
    known = sage_kernel.loss_and_gradients(params, PROFILE, sub)
    assert plain[0] == known[0] and all(np.array_equal(known[1][n], g) for n, g in plain[1].items())


def test_large_steps_equal_small_ones(small, monkeypatch):
    settings = GraphSet(hidden=3, learning_rate=0.05, weight_decay=1e-4, epochs=1, batch_size=4, fanouts=(2, 2))
    runs = sage_train.train_sage(small, settings, batches_per_step=3)
    monkeypatch.setattr(sage_train, "SMALL_STEP", 0)
    spread = sage_train.train_sage(small, settings, batches_per_step=3)
    assert all(np.allclose(spread.parameters[n], w, atol=1e-12) for n, w in runs.parameters.items())
    assert runs.metrics.first().loss == pytest.approx(spread.metrics.first().loss)


def test_training_rejects_bad_input(small):
    with pytest.raises(ValueError):
        sage_train.train_sage(small, GRAPH_SETS[0], loss_scope="everything")
    with pytest.raises(ValueError):
        sage_train.train_sage(small, GRAPH_SETS[0])  # 32 positives for a batch, but only 16 exist


def test_adam_first_step_has_the_size_of_the_rate():
    weights = np.array([1.0, -2.0])
    stepped = sage_train.Adam(2, 0.1, 0.0).step(weights, np.array([3.0, -0.5]))
    assert np.allclose(stepped, [0.9, -1.9], atol=1e-6)


def test_parameter_sets_keep_their_values():
    assert [(s.hidden, s.learning_rate, s.weight_decay) for s in GRAPH_SETS] == [(32, 0.01, 1e-5), (64, 0.01, 1e-4), (64, 0.001, 1e-4)]
    assert tree_set(1) is TREE_SETS[1]
    for wrong in (-1, 2):
        with pytest.raises(ValueError):
            tree_set(wrong)


def test_draws_are_distinct_and_seeded():
    draws = trees.random_draws(TREE_SETS[0], 20)
    assert len({tuple(sorted(d.items())) for d in draws}) == 20
    assert draws == trees.random_draws(TREE_SETS[0], 20)
    assert all(d[name] in TREE_SETS[0][name] for d in draws for name in d)
    assert len(trees.random_draws({"a": [1, 2]}, 20)) == 2


def test_search_finds_a_separable_label(spark):
    df = spark.range(90).select(
        F.col("id").cast("string").alias("user_id"),
        (F.col("id") % 7).alias("a"),
        (F.col("id") % 5).alias("b"),
        (F.col("id") % 7 > 4).cast("int").alias("y"),
    )
    grid = {"n_estimators": [2, 3], "max_depth": [2], "learning_rate": [0.1], "subsample": [1.0], "colsample_bytree": [1.0], "gamma": [0.0]}
    folds = trees.stratified_folds(df, "user_id", "y", 3)
    sizes = {(r.fold, r.y): r["count"] for r in folds.groupBy("fold", "y").count().collect()}
    for label in (0, 1):
        own = [sizes[fold, label] for fold in range(3)]
        assert max(own) - min(own) <= 1
    search = trees.random_search(df, "user_id", "y", ["user_id"], grid, draws=2)
    assert search.best in [d for d, _ in search.scores] and max(f1 for _, f1 in search.scores) == 1.0
    scored = trees.predict_trees(search.model, df, "y", ["user_id"])
    assert scored.where("pred <> label").count() == 0
    assert scored.columns == ["user_id", "prob", "pred", "label"]
    assert scored.count() == 90


def test_stored_search_predicts_the_same(spark, tmp_path):
    rng = np.random.default_rng(6)
    rows = [(i, float(a), float(b), int(a + b + rng.normal() > 0)) for i, (a, b) in enumerate(rng.normal(size=(200, 2)))]
    frame = spark.createDataFrame(rows, "user_id long, a double, b double, influential int")
    grid = {"n_estimators": [2, 3], "max_depth": [2], "learning_rate": [0.1, 0.3], "subsample": [1.0], "colsample_bytree": [1.0], "gamma": [0.0]}
    search = trees.random_search(frame, "user_id", "influential", ["user_id"], grid, draws=2, folds=2)
    for _ in range(2):  # storing again replaces
        artifacts.save_search(spark, search, str(tmp_path / "trees"))
    loaded = artifacts.load_search(spark, str(tmp_path / "trees"))
    assert loaded.best == search.best and loaded.scores == [({k: float(v) for k, v in d.items()}, f) for d, f in search.scores]
    predict = lambda model: sorted(map(tuple, trees.predict_trees(model, frame, "influential", ["user_id"]).collect()))
    assert predict(loaded.model) == predict(search.model)
    assert loaded.model.toDebugString == search.model.toDebugString
