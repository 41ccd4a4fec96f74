from __future__ import annotations

import hashlib
import subprocess
import sys
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark import cloudpickle
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from bowline.operators import evaluate, trainer
from bowline.operators.trainer import (
    Network,
    Rows,
    add_gradient,
    add_penalty,
    fit_lbfgs,
    fit_network,
    log_probabilities,
    loss_and_gradient,
    nesterov_step,
)
from bowline.plans import classification
from bowline.plans.classification import classify
from tests.conftest import rows_of

SCHEMA = "doc_id int, label int, indices array<int>, values array<double>"


def documents(seed=0, docs=60, features=20, classes=3, empty=True):
    """Each class prefers its own features; some documents have no entry at all."""
    rng = np.random.default_rng(seed)
    rows = []
    for d in range(docs):
        label = int(rng.integers(classes))
        liked = [f for f in range(features) if f % classes == label]
        chosen = sorted({int(f) for f in rng.choice(liked, 4)} | {int(f) for f in rng.integers(features, size=2)})
        if empty and d % 17 == 0:
            chosen = []
        rows.append((d, label, chosen, [float(v) for v in rng.uniform(0.5, 2.0, len(chosen))]))
    return rows


def as_rows(rows) -> Rows:
    return Rows(
        np.array([i for r in rows for i in r[2]], np.int32),
        np.array([v for r in rows for v in r[3]]),
        np.array([len(r[2]) for r in rows]),
        np.array([r[1] for r in rows]),
    )


def dense_gradient(network, flat, rows):
    """Mean loss and gradient by finite differences of a dense forward pass."""
    x = np.zeros((len(rows), network.layers[0]))
    for n, (_, _, indices, values) in enumerate(rows):
        x[n, indices] = values
    y = np.array([r[1] for r in rows])

    def loss(p):
        a, penalty = x, 0.0
        layers = network.unpack(p)
        for depth, (w, b) in enumerate(layers):
            a = a @ w + b
            penalty += 0.5 * network.l2 * (w * w).sum()
            if depth < len(layers) - 1:
                a = np.where(a > 0, a, network.leak * a)
        a = np.exp(a - a.max(axis=1, keepdims=True))
        return -np.log((a / a.sum(axis=1, keepdims=True))[np.arange(len(y)), y]).mean() + penalty

    gradient = np.zeros_like(flat)
    for i in range(len(flat)):
        up, down = flat.copy(), flat.copy()
        up[i] += 1e-6
        down[i] -= 1e-6
        gradient[i] = (loss(up) - loss(down)) / 2e-6
    return loss(flat), gradient


@pytest.mark.parametrize("layers", [(20, 3), (20, 3, 3), (20, 10, 3, 3)])
def test_gradient_equals_finite_differences(layers):
    network, rows = Network(layers, l2=0.01, seed=3), documents()
    flat = network.initial() + 0.01
    gradient = np.zeros(network.num_parameters)
    loss = add_gradient(network, flat, as_rows(rows), gradient) / len(rows)
    gradient /= len(rows)
    loss += add_penalty(network, flat, gradient)
    expected_loss, expected = dense_gradient(network, flat, rows)
    assert loss == pytest.approx(expected_loss, abs=1e-12)
    assert gradient == pytest.approx(expected, abs=1e-7)


@pytest.mark.parametrize(("cells", "max_rows"), [(1, None), (7, None), (40, 3), (1 << 20, None), (1 << 20, 16)])
def test_slices_cover_all_rows(monkeypatch, cells, max_rows):
    monkeypatch.setattr(trainer, "CELLS", cells)
    whole = as_rows(documents())
    parts = list(whole.slices(2, max_rows))
    for name in ("indices", "values", "lengths", "classes"):
        assert np.array_equal(np.concatenate([getattr(p, name) for p in parts]), getattr(whole, name))
    assert all(len(p.lengths) <= (max_rows or 10**9) for p in parts)
    assert all(len(p.indices) == p.lengths.sum() for p in parts)


def class_rows(spark, rows, partitions):
    df = spark.createDataFrame(rows, SCHEMA).withColumnRenamed("label", "class_id")
    return df.repartition(partitions)


def test_full_batch_training_is_exact_and_independent_of_partitions(spark, monkeypatch):
    monkeypatch.setattr(trainer, "BLOCK", 7)
    rows = documents()
    network = Network((20, 3, 3), seed=1)
    flat, velocity = network.initial(), np.zeros(network.num_parameters)
    for _ in range(4):
        gradient = np.zeros(network.num_parameters)
        add_gradient(network, flat, as_rows(rows), gradient)
        gradient /= len(rows)
        add_penalty(network, flat, gradient)
        nesterov_step(network, flat, velocity, gradient)
    for partitions in (1, 5):
        model = fit_network(class_rows(spark, rows, partitions), network, 4)
        assert model.flat == pytest.approx(flat, abs=1e-9)
        assert model.losses == sorted(model.losses, reverse=True)


def test_tasks_do_not_need_the_package_installed():
    payload = cloudpickle.dumps((Network((3, 2)), fit_network))
    code = "import pickle, sys; print(pickle.loads(sys.stdin.buffer.read())[0].num_parameters)"
    done = subprocess.run([sys.executable, "-I", "-c", code], input=payload, capture_output=True, cwd="/", check=True)
    assert done.stdout.strip() == b"8"


def test_nesterov_step():
    network = Network((1, 1), learning_rate=0.5, momentum=0.9)
    flat, velocity = np.array([1.0, 0.0]), np.array([0.1, 0.0])
    nesterov_step(network, flat, velocity, np.array([0.2, 0.0]))
    # velocity = 0.9 * 0.1 - 0.5 * 0.2 = -0.01; step = -0.9 * 0.1 + 1.9 * -0.01
    assert velocity[0] == pytest.approx(-0.01) and flat[0] == pytest.approx(1 - 0.09 - 0.019)


def test_average_training_on_one_partition_is_local_training(spark):
    rows = documents()
    network = Network((20, 3, 3), seed=1)
    data = class_rows(spark, rows, 1)
    order = data.orderBy(F.xxhash64("indices", "values", "class_id")).select("doc_id").collect()
    model = fit_network(data, network, 2, "average", batch_size=8, workers=1)
    rows = [rows[r["doc_id"]] for r in order]
    flat, velocity = network.initial(), np.zeros(network.num_parameters)
    for _ in range(2):
        for at in range(0, len(rows), 8):
            part = rows[at : at + 8]
            gradient = np.zeros(network.num_parameters)
            add_gradient(network, flat, as_rows(part), gradient)
            gradient /= len(part)
            add_penalty(network, flat, gradient)
            nesterov_step(network, flat, velocity, gradient)
    assert model.flat == pytest.approx(flat, abs=1e-9)
    spread, same = (fit_network(class_rows(spark, rows, n), network, 6, "average", batch_size=8, workers=3) for n in (4, 1))
    assert spread.losses[-1] < spread.losses[0]
    assert spread.flat == pytest.approx(same.flat, abs=1e-9)  # files and cores do not matter, the learners do
    began = fit_network(data, network, 1, "average", batch_size=8, workers=1, initial=model.flat)
    assert began.losses[0] < model.losses[0]


def test_learners_by_key_batches_and_averaging_rounds(spark):
    """Three learners, four batches each, averaged after every three: the same as one after another by hand."""
    rows = documents(docs=90)
    network = Network((20, 3, 3), seed=1)
    data = class_rows(spark, rows, 4)
    options = {"workers": 3, "key": ["doc_id"], "batches": 4}
    model = fit_network(data, network, 2, "average", average_every=3, **options)

    def dealt(doc):
        digest = hashlib.md5(str(doc).encode()).hexdigest()
        return int(digest[:7], 16) % 3, int(digest[7:14], 16) % 4

    flat, velocity, losses = network.initial(), np.zeros(network.num_parameters), []
    for _ in range(2):
        epoch = 0.0
        for group in ((0, 1, 2), (3,)):
            ends, weights = [], []
            for learner in range(3):
                mine, speed, docs = flat.copy(), velocity.copy(), 0
                for batch in group:
                    part = [r for r in rows if dealt(r[0]) == (learner, batch)]
                    if part:
                        gradient = np.zeros(network.num_parameters)
                        epoch += add_gradient(network, mine, as_rows(part), gradient)
                        gradient /= len(part)
                        add_penalty(network, mine, gradient)
                        nesterov_step(network, mine, speed, gradient)
                        docs += len(part)
                ends.append((mine, speed))
                weights.append(docs)
            flat, velocity = (sum(n * e[k] for n, e in zip(weights, ends, strict=True)) / sum(weights) for k in (0, 1))
        losses.append(epoch / len(rows))
    assert model.flat == pytest.approx(flat, abs=1e-9)
    assert model.losses == pytest.approx(losses)
    once = fit_network(data, network, 2, "average", **options)
    assert once.flat != pytest.approx(flat, abs=1e-6)  # averaging less often is another model
    with pytest.raises(ValueError, match="batches too"):
        fit_network(data, network, 1, "average", average_every=2)


def test_lazy_rows_equal_dense_steps_and_touch_what_documents_have(monkeypatch):
    rng = np.random.default_rng(3)
    network = Network((5000, 4, 3), l2=0.02, seed=4)
    rows = [(d, d % 3, sorted({int(i) for i in rng.integers(0, 5000, 6)} | {7}), None) for d in range(60)]
    rows = [(d, y, i, [1.0 + k for k in range(len(i))]) for d, y, i, _ in rows]
    table = pa.RecordBatch.from_pydict(
        {"indices": [r[2] for r in rows], "values": [r[3] for r in rows], "class_id": [r[1] for r in rows], "_batch": [0] * 60}
    )
    refreshed, original = [], trainer.LazyRows.refresh

    def counting(self, which):
        refreshed.append(len(which))
        original(self, which)

    monkeypatch.setattr(trainer.LazyRows, "refresh", counting)
    start, speed = network.initial(), 0.01 * rng.standard_normal(network.num_parameters)
    flat, velocity, loss, docs = trainer.local_training(network, start, speed, 8)([table])
    dense, v, total = start.copy(), speed.copy(), 0.0
    for at in range(0, 60, 8):
        part = rows[at : at + 8]
        gradient = np.zeros(network.num_parameters)
        total += add_gradient(network, dense, as_rows(part), gradient)
        gradient /= len(part)
        add_penalty(network, dense, gradient)
        nesterov_step(network, dense, v, gradient)
    assert flat == pytest.approx(dense, abs=1e-12) and velocity == pytest.approx(v, abs=1e-12)
    assert loss == pytest.approx(total) and docs == 60
    assert refreshed[-1] == 5000 and max(refreshed[:-1]) <= 8 * 7  # all of them once, at the end


def test_learners_get_even_parts_and_copies_are_spread(spark):
    rows = spark.range(8000).selectExpr("id AS doc_id", "array(1) AS indices", "array(1.0D) AS values", "0 AS class_id")
    dealt = trainer.deal(rows, 8, ["doc_id"])
    per_task = dealt.groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert len(per_task) == 8 and max(r["count"] for r in per_task) < 1.2 * 1000
    plain = rows.withColumn("indices", F.array(F.col("doc_id").cast("int")))
    per_task = trainer.deal(plain, 8).groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert len(per_task) == 8 and max(r["count"] for r in per_task) < 1.2 * 1000


def test_gradients_travel_as_their_numbers_that_are_not_zero(spark, monkeypatch):
    monkeypatch.setattr(trainer, "BLOCK", 50)
    rng = np.random.default_rng(2)
    flat = np.zeros(1000)
    flat[[3, 4, 777]] = rng.standard_normal(3)
    flat[100:150] = rng.standard_normal(50)
    sent = pa.Table.from_batches(trainer.emit_blocks(flat, 1.5, 7))
    assert sent.column("block").to_pylist() == [0, 2, 15]
    assert sum(map(len, sent.column("numbers").to_pylist())) == 8 * 53
    got = pa.Table.from_batches(trainer.adder(1000)([*sent.to_batches(), *sent.to_batches()])).to_pylist()
    total = np.zeros(1000)
    for row in got:
        total[row["block"] * 50 : (row["block"] + 1) * 50] = np.frombuffer(row["numbers"])
    assert np.array_equal(total, 2 * flat) and sum(r["docs"] for r in got) == 14

    # A task that saw few words of a wide input sends little.
    network = Network((100_000, 3, 3))
    rows = trainer.Rows(np.array([5, 70_000]), np.ones(2), np.array([2]), np.array([1]))
    gradient = np.zeros(network.num_parameters)
    trainer.add_gradient(network, network.initial(), rows, gradient)
    sent = pa.Table.from_batches(trainer.emit_blocks(gradient, 0.0, 1))
    assert sum(map(len, sent.column("numbers").to_pylist())) <= 8 * (2 * 3 + 3 + 9 + 3)


@pytest.mark.parametrize("outputs", [3, 40])
def test_separable_weights(outputs):
    w = trainer.separable_weights(50, outputs)
    assert np.linalg.matrix_rank(w) == 1 and w.all()
    assert np.array_equal(w[:, 0], w[:, 16]) if outputs > 16 else len(set(w[0])) == outputs
    assert np.var(trainer.separable_weights(1600, 1600)) == pytest.approx(2 / 3200, rel=0.05)
    assert np.array_equal(Network((50, outputs), start="separable").unpack(Network((50, outputs), start="separable").initial())[0][0], w)
    with pytest.raises(ValueError, match="start"):
        Network((3, 2), start="other")


def test_lbfgs_finds_the_optimum(spark):
    rows = documents(docs=120)
    network = Network((20, 3), l2=0.05)
    data = class_rows(spark, rows, 3).coalesce(3).cache()
    model = fit_lbfgs(data, network, 60)
    loss, gradient = trainer.loss_and_gradient(data, network, model.flat)
    assert np.abs(gradient).max() < 1e-4 and loss == pytest.approx(model.losses[-1])
    assert model.losses == sorted(model.losses, reverse=True)
    slow = fit_network(data, Network((20, 3), l2=0.05, learning_rate=0.3), 60)
    assert model.losses[-1] <= slow.losses[-1]
    again = fit_lbfgs(data, network, 5, initial=model.flat)
    assert again.losses[-1] == pytest.approx(model.losses[-1], abs=1e-6)
    data.unpersist()


def test_two_loops_solve_a_quadratic():
    rng = np.random.default_rng(1)
    a = rng.standard_normal((6, 6))
    a = a @ a.T + np.eye(6)
    steps = list(np.linalg.eigh(a)[1].T)  # conjugate directions: with all of them the inverse is exact
    changes = [a @ s for s in steps]
    g = rng.standard_normal(6)
    assert trainer.two_loops(g, steps, changes) == pytest.approx(np.linalg.solve(a, g))
    assert np.array_equal(trainer.two_loops(g, [], []), g)


def test_prediction_equals_the_forward_pass(spark):
    rows = documents()
    network = Network((20, 10, 3, 3), seed=2)
    model = trainer.TrainedNetwork(network, network.initial())
    got = {r["doc_id"]: r["p"] for r in model.predict(spark.createDataFrame(rows, SCHEMA), "p").collect()}
    expected = log_probabilities(network, model.flat, as_rows(rows))[0].argmax(axis=1)
    assert [got[d] for d in range(len(rows))] == expected.tolist()


def test_no_documents_and_oversized_networks(spark):
    with pytest.raises(ValueError, match="no training documents"):
        fit_network(class_rows(spark, [], 1), Network((2, 2)), 1)
    with pytest.raises(ValueError, match="exceed"):
        Network((10**6, 10**6, 2))
    with pytest.raises(ValueError, match="sync"):
        fit_network(class_rows(spark, documents(), 1), Network((20, 3)), 1, "none")


@pytest.mark.parametrize(
    ("kind", "epochs", "options"),
    [
        ("softmax", 30, {}),
        ("softmax", 30, {"sparse": True}),
        ("softmax", 30, {"solver": "mlp"}),
        ("shallow", 60, {"learning_rate": 0.3}),
        ("deep", 60, {"learning_rate": 0.3}),
        ("average", 30, {"learning_rate": 0.1}),
    ],
)
def test_every_kind_learns_a_separable_set(spark, kind, epochs, options):
    # labels with gaps: predictions come back in terms of the labels, not of dense ids
    train = [(d, 10 * y + 5, i, v) for d, y, i, v in documents(1, 240, empty=False)]
    test = [(d, 10 * y + 5, i, v) for d, y, i, v in documents(2, 30, empty=False)] + [(99, 77, [1], [1.0]), (98, None, [1], [1.0])]
    result = classify(spark.createDataFrame(train, SCHEMA), spark.createDataFrame(test, SCHEMA), 20, kind, epochs, **options)
    assert result.classes == [5, 15, 25]
    assert {r["prediction"] for r in result.training.collect()} <= {5, 15, 25}
    got = {r["split"]: r for r in result.metrics().collect()}
    assert got["training"]["num_docs"] == 240 and got["validation"]["num_docs"] == 31
    assert got["training"]["accuracy"] > 0.9 and got["validation"]["accuracy"] > 0.8
    pairs = result.confusion()
    assert pairs.filter("split = 'validation' and label = 77").agg(F.sum("num_docs")).first()[0] == 1
    assert result.validation.count() == 32


def test_the_perceptron_gets_rows_dealt_by_their_dense_size(spark, monkeypatch):
    """One file of sparse rows was one task, which held all of them dense."""
    parts, fit = [], MultilayerPerceptronClassifier.fit

    def recording(self, rows):
        parts.extend(r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect())
        return fit(self, rows)

    monkeypatch.setattr(MultilayerPerceptronClassifier, "fit", recording)
    rows = spark.createDataFrame(documents(1, 700, empty=False), SCHEMA)
    classify(rows.coalesce(1), rows, 20, "softmax", 2, solver="mlp")
    assert parts == [700]  # a few rows stay where they are
    monkeypatch.setattr(classification, "DENSE_TASK", 20 * 8 * 300)
    for files in (1, 3):
        parts.clear()
        classify(rows.repartition(files), rows, 20, "softmax", 2, solver="mlp")
        assert sorted(parts) == [188, 256, 256]  # whole blocks of 128 rows, but for the last


def test_training_without_epochs_and_bad_arguments(spark):
    df = spark.createDataFrame(documents(), SCHEMA)
    for kind in ("softmax", "shallow"):
        assert classify(df, df, 20, kind).metrics().count() == 2
    with pytest.raises(ValueError, match="kind must be"):
        classify(df, df, 20, "other")
    with pytest.raises(ValueError, match="solver"):
        classify(df, df, 20, solver="other")
    with pytest.raises(ValueError, match="no labelled"):
        classify(df.withColumn("label", F.lit(None).cast("int")), df, 20)


def test_metrics_equal_ml(spark):
    rng = np.random.default_rng(4)
    pairs = [(float(rng.integers(4)), float(rng.integers(3))) for _ in range(500)]
    df = spark.createDataFrame(pairs, "label double, prediction double")
    row = evaluate.metrics(evaluate.confusion(df)).first()
    for ours, theirs in (("accuracy", "accuracy"), ("precision", "weightedPrecision"), ("recall", "weightedRecall"), ("f1", "f1")):
        assert row[ours] == pytest.approx(MulticlassClassificationEvaluator(metricName=theirs).evaluate(df), abs=1e-12)
    report = evaluate.class_report(evaluate.confusion(df))
    assert rows_of(report.select("class"))[-1] == (3.0,)
    assert report.filter("class = 3").first()["predicted"] == 0


def test_full_batch_steps_hold_no_third_vector_on_the_driver(spark):
    """Long vectors: the steps of whole gradients, with weights and velocities alone on the driver."""
    network = Network((150_000, 8, 2), start="separable")
    rows = [([n, 70_000 + n, 149_000 + n % 9], [1.0, 0.5, -2.0], n % 2) for n in range(40)]
    data = spark.createDataFrame(rows, "indices array<int>, values array<double>, class_id int").repartition(3).cache()
    data.count()
    flat, velocity, losses = network.initial(), np.zeros(network.num_parameters), []
    for _ in range(2):
        loss, gradient = loss_and_gradient(data, network, flat)
        losses.append(loss)
        nesterov_step(network, flat, velocity, gradient)
    del gradient
    tracemalloc.start()
    trained = fit_network(data, network, 2)
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    data.unpersist()
    assert np.array_equal(trained.flat, flat)
    assert trained.losses == pytest.approx(losses, abs=1e-12)
    assert peak < 3.5 * flat.nbytes


def test_wide_layers_take_rows_a_few_at_once(monkeypatch):
    """All entries of a slice times the layer's width were an array, several times over."""
    rng = np.random.default_rng(2)
    lengths = np.array([1500, 0, 1, 1200, 1299])
    indices = np.concatenate([np.sort(rng.permutation(1600)[:n]) for n in lengths]).astype(np.int32)
    rows = trainer.Rows(indices, rng.normal(size=len(indices)), lengths, np.array([0, 1, 1, 0, 1]))
    network = Network((1600, 1000, 2, 2))
    flat = network.initial()

    def gradient() -> tuple[float, np.ndarray, int]:
        into = np.zeros(network.num_parameters)
        tracemalloc.start()
        loss = sum(trainer.add_gradient(network, flat, some, into) for some in rows.slices(1000))
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return loss, into, peak

    loss, found, peak = gradient()
    monkeypatch.setattr(trainer, "WIDE", 1 << 30)
    expected_loss, expected, whole = gradient()
    assert np.isclose(loss, expected_loss, rtol=1e-12) and np.allclose(found, expected, rtol=1e-9, atol=1e-12)
    assert peak < 8 << 20 < 32 << 20 <= whole
    with pytest.raises(IndexError):
        trainer.add_products(flat.reshape(-1, 1), np.array([len(flat)]), np.ones(1), np.array([0]), np.array([1]), np.zeros((1, 1)), [0])


def test_long_gradients_are_one_per_core_and_reach_the_driver_in_parts(spark, monkeypatch):
    """Every file sent out a gradient of its own, and small parts were brought together before they came."""
    rows = [([i % 50], [1.0], i % 2) for i in range(400)]
    data = spark.createDataFrame(rows, "indices array<int>, values array<double>, class_id int").repartition(40)
    network = Network((50, 30, 2, 2))
    expected = fit_network(data, network, 2).flat
    sizes = []
    original = trainer.gradient_parts

    def recording(*args):
        sizes.append((parts := original(*args)).rdd.getNumPartitions())
        return parts

    monkeypatch.setattr(trainer, "gradient_parts", recording)
    monkeypatch.setattr(trainer, "AT_ONCE", 100)
    monkeypatch.setattr(trainer, "BLOCK", 64)
    assert np.allclose(fit_network(data, network, 2).flat, expected, rtol=1e-12)
    assert sizes == [spark.sparkContext.defaultParallelism] * 2
