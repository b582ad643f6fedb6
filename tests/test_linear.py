"""Chunked and continued regression against plain numpy."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from postsift.operators import linear as L
from postsift.operators import naive_bayes as NB
from postsift.operators.evaluate import loss_history
from postsift.operators.linear import Linear, LinearConfig, evaluate, fit_linear, fit_linear_tasks, score_linear
from postsift.sources.models import load_model, save_model

CONFIG = LinearConfig(epochs=6, features=512, reg=1e-3)


def posts(seed, n, words=("good", "fine"), bad=("awful", "vile")):
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        y = int(rng.integers(0, 2))
        text = [*rng.choice(bad if y else words, 2), *rng.choice(["so", "and", "the", "a"], 5)]
        out.append((i, y if rng.random() > 0.05 else 1 - y, [str(t) for t in text]))
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "id int, label int, tokens array<string>").repartition(3)


def plain(rows, features):
    """Values and labels as dense arrays."""
    at = [[zlib.crc32(t.encode()) % features for t in tokens] for _, _, tokens in rows]
    df = np.bincount([p for places in at for p in set(places)], minlength=features)
    idf = np.log((len(rows) + 1) / (df + 1))
    x = np.zeros((len(rows), features))
    for i, places in enumerate(at):
        length = np.sqrt(sum(idf[p] ** 2 for p in places)) or 1.0
        for p in places:
            x[i, p] += idf[p] / length
    return x, np.array([r[1] for r in rows]), idf


def test_loss_and_gradient(spark):
    rows = [*posts(1, 60), (99, 1, []), (98, 0, ["unseen"])]
    x, y, idf = plain(rows, 64)
    weights = np.random.default_rng(0).normal(size=(1, 65))
    at = F.transform("tokens", lambda t: (F.crc32(t.cast("binary")) % 64).cast("int"))
    loss, gradient = evaluate(frame(spark, rows).select(F.lit(0).alias("task"), "label", at.alias("places")), weights, idf[None], 0.1)
    margin = x @ weights[0, :-1] + weights[0, -1]
    assert loss[0] == pytest.approx(np.mean(np.logaddexp(0, np.where(y == 1, -margin, margin))) + 0.05 * (weights[0, :-1] ** 2).sum())
    error = 1 / (1 + np.exp(-margin)) - y
    assert gradient[0, :-1] == pytest.approx(x.T @ error / len(y) + 0.1 * weights[0, :-1])
    assert gradient[0, -1] == pytest.approx(error.mean())


def test_learns_and_its_loss_falls(spark):
    df = frame(spark, posts(2, 300))
    model = fit_linear(df, CONFIG)
    losses = [h[2] for h in model.history]
    assert [h[:2] for h in model.history] == [(0, e) for e in range(7)]
    assert losses[0] == pytest.approx(np.log(2)) and all(b <= a for a, b in zip(losses, losses[1:], strict=False))
    scored = score_linear(frame(spark, posts(3, 200)), model)
    assert scored.where("prediction = label").count() > 180
    assert scored.columns == ["id", "label", "tokens", "prediction", "probability"]


def test_goes_on_from_a_saved_model(spark, tmp_path):
    first, second = frame(spark, posts(4, 300)), frame(spark, posts(5, 300, ("good", "nice"), ("awful", "rude")))
    model = fit_linear(first, CONFIG)
    save_model(model, str(tmp_path), "spam", spark)
    saved = load_model(str(tmp_path), "spam", spark)
    assert np.array_equal(saved.weights, model.weights) and np.array_equal(saved.idf, model.idf) and saved.history == model.history
    warm, cold = fit_linear(second, CONFIG, start=saved), fit_linear(second, CONFIG)
    assert warm.history[:7] == model.history and warm.history[7][0] == 1
    for w, c in zip(warm.history[7:], cold.history, strict=True):
        assert w[1] == c[1] and w[2] <= c[2]
    assert [tuple(r) for r in loss_history(saved, spark).collect()] == [(i, h[2]) for i, h in enumerate(model.history)]


def test_chunks(spark):
    rows = posts(6, 400)
    model = fit_linear(frame(spark, rows), LinearConfig(epochs=3, features=512, reg=1e-3, step_rows=100))
    assert [h[:2] for h in model.history] == [(c, e) for c in range(4) for e in range(4)]
    starts = [h[2] for h in model.history if h[1] == 0]
    assert starts[-1] < starts[0]


def test_tasks_in_the_same_passes_equal_tasks_alone(spark):
    a, b = frame(spark, posts(7, 200)), frame(spark, posts(8, 120, ("good",), ("rude",)))
    both = a.withColumn("task", F.lit("a")).union(b.withColumn("task", F.lit("b")))
    together = fit_linear_tasks(both, CONFIG)
    for name, df in (("a", a), ("b", b)):
        alone = fit_linear(df, CONFIG)
        assert together[name].weights == pytest.approx(alone.weights, abs=1e-9)
        assert [h[2] for h in together[name].history] == pytest.approx([h[2] for h in alone.history])


def test_edge_cases(spark):
    rows = [*posts(9, 50), (50, None, ["x"]), (51, 2, ["x"]), (52, 1, None), (53, 1, []), *posts(9, 50)]
    model = fit_linear(frame(spark, rows), CONFIG)
    scored = {r.id: r for r in score_linear(frame(spark, [(1, 0, None), (2, 0, []), (3, 0, ["never", "seen"])]), model).collect()}
    assert scored[1].prediction is None and scored[2].prediction in (0, 1) and scored[3].probability >= 0.5
    with pytest.raises(ValueError, match="no labelled row"):
        fit_linear(frame(spark, [(1, None, ["a"])]), CONFIG)
    with pytest.raises(ValueError, match="other places"):
        fit_linear(frame(spark, rows), LinearConfig(features=64), start=model)
    one = fit_linear(frame(spark, [(1, 1, ["a"]), (2, 1, ["b"])]), CONFIG)
    assert isinstance(one, Linear) and one.weights[-1] > 0


def test_batches_are_taken_in_slices(monkeypatch):
    """Sums and margins hold temporary arrays of a bounded number of tokens, whatever the batch."""
    rng = np.random.default_rng(1)
    lists = [rng.integers(0, 8, n).tolist() for n in (3, 0, 9, 1, 5, 2)]
    batch = pa.RecordBatch.from_pydict(
        {"task": pa.array([0, 1, 0, 1, 1, 0], pa.int32()), "label": pa.array([0, 1, 1, 0, 1, 0], pa.int32()), "part": pa.array([4] * 6, pa.int32()), "places": pa.array(lists, pa.list_(pa.int32()))}
    )
    seen, values = [], L._values
    monkeypatch.setattr(L, "_values", lambda some, *more: (seen.append(len(some.flatten())), values(some, *more))[1])
    whole, sliced = [], []
    for most, out in ((1000, whole), (4, sliced)):
        monkeypatch.setattr(NB, "AT_ONCE", most)
        for made in L.gradients(rng.normal(size=(2, 9)) * 0 + 0.25, np.ones((2, 8)))(iter([batch])):
            out += [(r["task"], r["block"], r["part"], np.frombuffer(r["sums"])) for r in made.to_pylist()]
    assert seen[0] == 20 and max(seen[1:]) == 9 and len(seen) > 4
    for a, b in zip(whole, sliced, strict=True):
        assert a[:3] == b[:3] and np.allclose(a[3], b[3])
