"""Lock-step boosting against a plain booster that grows each fit on its own, row by row."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from martloom.operators import boosting
from martloom.operators.boosting import Boosting, Fit, Trees, boost
from martloom.session import cut


def shrink(g, l1):
    return np.sign(g) * max(abs(g) - l1, 0)


def plain(x, y, w, key, fold, fit, number, s, points):
    """Margins and (feature, threshold) splits of one fit."""
    learn = np.ones(len(y), bool) if fit.left_out is None else fold != fit.left_out
    mean = (y * w)[learn].sum() / w[learn].sum()
    f, splits = np.full(len(y), np.log(mean / (1 - mean)) if s.logistic else mean), []
    for tree in range(s.rounds):
        rows = learn & boosting.sampled(key, s.row_share, s.seed, number, tree)
        p = 1 / (1 + np.exp(-f)) if s.logistic else f
        g, h = (p - y) * w, (p * (1 - p) if s.logistic else np.ones(len(y))) * w
        allowed = boosting._features(fit, s, number, tree)
        step = np.zeros(len(y))

        def grow(inside, depth):
            used = inside & rows
            total_g, total_h = g[used].sum(), h[used].sum()
            best = (1e-6, None)
            if depth < s.depth:
                for j in allowed:
                    for t in points[j]:
                        left = used & ~(x[:, j] > t)
                        lg, lh = g[left].sum(), h[left].sum()
                        if lh < s.min_weight or total_h - lh < s.min_weight:
                            continue
                        score = lambda a, b: shrink(a, s.l1) ** 2 / (b + s.l2)
                        gain = score(lg, lh) + score(total_g - lg, total_h - lh) - score(total_g, total_h)
                        if gain > best[0] + 1e-7:
                            best = (gain, (j, t))
            if best[1] is None:
                step[inside] = -shrink(total_g, s.l1) / (total_h + s.l2) * s.rate if total_h > 0 else 0
                return
            j, t = best[1]
            # the split that lies nearest to, but not above, the middle of the gap between the values on both sides
            right = x[used, j][x[used, j] > t]
            same = [p for p in points[j] if t <= p < right.min()]
            nearest = points[j][points[j] >= right.min()]
            middle = (t + (nearest[0] if len(nearest) else points[j][-1])) / 2
            t = max(p for p in same if p <= middle or p == t)
            splits.append((tree, int(j), float(t)))
            grow(inside & ~(x[:, j] > t), depth + 1)
            grow(inside & (x[:, j] > t), depth + 1)

        grow(np.ones(len(y), bool), 0)
        f = f + step
    return f, splits


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(5)
    n = 300
    x = np.round(rng.normal(size=(n, 4)), 1)
    x[:, 3] = rng.integers(0, 2, n)
    x[::17, 1] = np.nan
    y = np.nan_to_num(x[:, 0]) * 2 + (np.nan_to_num(x[:, 1]) > 0.3) * 3 + x[:, 3] + rng.normal(size=n) * 0.1
    rows = [(i, *(None if np.isnan(v) else float(v) for v in r), float(t), int(t > 2), 4.0 if t > 2 else 1.0, i % 3) for i, (r, t) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, d double, y double, z int, w double, fold int").repartition(5)
    return cut(df, "boosting-test"), x, y


FITS = [Fit((0, 1, 2, 3)), Fit((0, 1, 2, 3), 1), Fit((2, 3), 2), Fit((1,), 0)]


@pytest.mark.parametrize("logistic", [False, True])
@pytest.mark.parametrize(("tasks", "cells"), [(boosting.ROWS, boosting.CELLS), (70, boosting.CELLS), (70, 20)])
def test_against_a_plain_booster(spark, table, monkeypatch, logistic, tasks, cells):
    monkeypatch.setattr(boosting, "ROWS", tasks)  # several blocks and tasks
    monkeypatch.setattr(boosting, "CELLS", cells)  # one pass per round, or one per level
    monkeypatch.setattr(boosting, "WINDOW", 3)
    df, x, y = table
    s = Boosting(rounds=7, depth=3, rate=0.3, min_weight=2.0, logistic=logistic, bins=64)
    label, weight = ("z", "w") if logistic else ("y", None)
    fitted = boost(df, ["a", "b", "c", "d"], label, "id", FITS, s, cut, "fold", weight, keep=["id"])
    got = {r["id"]: r for r in fitted.rows.collect()}
    key = np.array([r[0] for r in df.orderBy("id").select(F.xxhash64("id")).collect()], np.int64).view(np.uint64)
    points = boosting.cut_points(df, ["a", "b", "c", "d"], 64)
    target = (y > 2).astype(float) if logistic else y
    w = 1 + 3.0 * (y > 2) if logistic else np.ones(len(y))
    for k, fit in enumerate(FITS):
        margins, splits = plain(x, target, w, key, np.arange(len(y)) % 3, fit, k, s, points)
        assert np.allclose([got[i].predictions[k] for i in range(len(y))], margins, atol=1e-6)
        t = fitted.trees[k]
        mine = [(a, int(t.feature[a, n]), float(t.threshold[a, n])) for a in range(7) for n in range(7) if t.gain[a, n] > 0]
        assert sorted(mine) == sorted(splits)
        assert np.allclose(t.margins(x), margins, atol=1e-6)
    assert {tuple(r)[:4] for r in fitted.rows.select("fold", "label", "weight", "id").collect()} == {
        (i % 3, float(target[i]), float(w[i]), i) for i in range(len(y))
    }


def test_same_trees_whatever_the_partitions(spark, table):
    df, x, _ = table
    s = Boosting(rounds=5, depth=4)
    first, second = (boost(d, ["a", "b", "c", "d"], "y", "id", FITS[:2], s, cut, "fold").trees for d in (df, df.repartition(11)))
    for a, b in zip(first, second):
        assert (a.feature == b.feature).all() and (a.threshold == b.threshold).all() and (a.leaf == b.leaf).all()


def test_saved_trees_predict_alike(spark, table, tmp_path):
    df, x, _ = table
    t = boost(df, ["a", "b", "c", "d"], "z", "id", FITS[:1], Boosting(rounds=6, logistic=True), cut).trees[0]
    t.save(spark, str(tmp_path))
    loaded = Trees.load(spark, str(tmp_path))
    got = loaded.predict(df, "p").orderBy("id").collect()
    assert np.allclose([r.p for r in got], 1 / (1 + np.exp(-t.margins(x))), atol=1e-12)
    assert got[0].asDict().keys() == {*df.columns, "p"}
    assert t.importance().sum() == pytest.approx(1)


def test_odd_inputs(spark, table):
    df, _, _ = table
    s = Boosting(rounds=2)
    with pytest.raises(ValueError, match="label"):
        boost(df.where("false"), ["a"], "y", "id", [Fit((0,))], s, cut)
    flat = boost(df.withColumn("a", F.lit(None).cast("double")).withColumn("y", F.lit(3.0)), ["a"], "y", "id", [Fit((0,))], s, cut)
    assert {round(r.predictions[0], 9) for r in flat.rows.collect()} == {3.0}
    part = boost(df.withColumn("y", F.when(F.col("id") < 200, F.col("y"))), ["a"], "y", "id", [Fit((0,))], s, cut)
    assert part.rows.count() == 200
