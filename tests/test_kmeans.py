"""k-means against a plain Python twin, its invariants, and executor loss."""

import numpy as np
import pytest

from clientele.operators import kmeans, segments


def _twin_lloyd(x, centers, max_iter):
    """Lloyd's steps row by row; labels, centres and cost at the end."""
    centers = [list(c) for c in centers]
    for _ in range(max_iter + 1):
        label = [min(range(len(centers)), key=lambda j: (sum((a - b) ** 2 for a, b in zip(p, centers[j])), j)) for p in x]
        new = []
        for j, c in enumerate(centers):
            own = [p for p, lab in zip(x, label) if lab == j]
            new.append([sum(v) / len(own) for v in zip(*own)] if own else c)
        if all(abs(a - b) < 1e-10 for u, v in zip(new, centers) for a, b in zip(u, v)):
            break
        centers = new
    return label, _cost(x, label, len(centers))


def _cost(x, label, k):
    total = 0.0
    for j in range(k):
        own = [p for p, lab in zip(x, label) if lab == j]
        if own:
            mean = [sum(v) / len(own) for v in zip(*own)]
            total += sum((a - b) ** 2 for p in own for a, b in zip(p, mean))
    return total


def _best_transfer(x, label, k):
    """The largest fall of the cost by moving one row, by trying every move."""
    now, best = _cost(x, label, k), 0.0
    for i in range(len(x)):
        for j in range(k):
            if j != label[i]:
                best = max(best, now - _cost(x, [*label[:i], j, *label[i + 1:]], k))
    return best


@pytest.fixture(scope="module")
def points():
    rng = np.random.default_rng(12)
    x = np.vstack([rng.normal(c, 1.3, size=(14, 2)) for c in ((0, 0), (3, 1), (1, 4))])
    return np.round(np.vstack([x, x[:3], x[:3]]), 3)  # repeated rows


def _frame(spark, x, parts=3):
    rows = [(i, *map(float, r)) for i, r in enumerate(x)]
    schema = "customer_id long, " + ", ".join(f"c{j} double" for j in range(x.shape[1]))
    return spark.createDataFrame(rows, schema).repartition(parts)


def test_equals_the_twin_and_ends_in_a_transfer_optimum(spark, points):
    rng = np.random.default_rng(3)
    starts = [np.unique(points, axis=0)[rng.choice(40, size=k, replace=False)] for k in (2, 3, 4) for _ in range(3)]
    blocks = kmeans.packed(_frame(spark, points), ["c0", "c1"])
    runs = kmeans.fit(blocks, starts, 100)
    lower = 0
    for start, run in zip(starts, runs):
        _, lloyd = _twin_lloyd(points.tolist(), start, 100)
        assert run.cost <= lloyd + 1e-9
        lower += run.cost < lloyd - 1e-9
        # a transfer optimum's labels are those of the nearest centre
        d = ((points[:, None, :] - run.centers[None]) ** 2).sum(axis=2)
        label = d.argmin(axis=1).tolist()
        assert abs(_cost(points.tolist(), label, len(start)) - run.cost) < 1e-8
        assert _best_transfer(points.tolist(), label, len(start)) < 1e-8
    assert lower  # some Lloyd optimum is left by a transfer


def test_without_transfers_the_cost_is_lloyds(spark, points, monkeypatch):
    monkeypatch.setattr(kmeans, "LEAST_GAIN", np.inf)
    starts = [points[[0, 20, 30]], points[[1, 2]]]
    for start, run in zip(starts, kmeans.fit(kmeans.packed(_frame(spark, points), ["c0", "c1"]), starts, 100)):
        assert abs(run.cost - _twin_lloyd(points.tolist(), start, 100)[1]) < 1e-8


def test_many_tasks_give_the_same_runs(spark, points, monkeypatch):
    """Partial rows beyond the fan-in are added in Spark; blocks may be small."""
    starts = [points[[0, 20, 30]], points[[5, 6, 7]]]
    want = kmeans.fit(kmeans.packed(_frame(spark, points, 2), ["c0", "c1"]), starts, 100)
    monkeypatch.setattr(kmeans, "FAN_IN", 2)
    monkeypatch.setattr(kmeans, "BLOCK", 4)
    got = kmeans.fit(kmeans.packed(_frame(spark, points, 7), ["c0", "c1"]), starts, 100)
    for g, w in zip(got, want):
        assert abs(g.cost - w.cost) < 1e-8


def test_empty_and_single_member_clusters(spark):
    x = np.array([[0.0], [0.0], [1.0], [9.0]])
    runs = kmeans.fit(kmeans.packed(_frame(spark, x), ["c0"]), [np.array([[0.0], [100.0], [200.0]])], 50)
    assert runs[0].cost < 1e-9 and sorted(runs[0].sizes) == [1, 1, 2]


def test_clusters_of_a_mart_need_no_join(spark):
    from conftest import SF_SMALL
    from clientele.plans.catalog import _dm
    dm = _dm(spark, SF_SMALL)
    got = segments.customer_clusters(dm, k=3, restarts=2)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and got.count() == dm.count()
    rows = got.groupBy("cluster").count().collect()
    assert len(rows) == 3
    same = segments.kmeans_segments(segments.kmeans_features(dm), k=3, restarts=2)
    assert sorted(map(tuple, same.collect())) == sorted((r["customer_id"], r["cluster"]) for r in got.collect())


def test_fixed_starts_equal_plain_lloyd(spark):
    from clientele.operators import segments
    rng = np.random.default_rng(8)
    cols = segments.KMEANS_INPUTS + ["cat_ratio_fashion"]
    x = rng.normal(size=(300, len(cols)))
    dm = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)],
                               "customer_id long, " + ", ".join(f"{c} double" for c in cols))
    z = (x - x.mean(axis=0)) / x.std(axis=0, ddof=1)
    centers = z[:4]
    for _ in range(3):
        label = ((z[:, None] - centers[None]) ** 2).sum(axis=2).argmin(axis=1)
        centers = np.array([z[label == c].mean(axis=0) for c in range(4)])
    label = ((z[:, None] - centers[None]) ** 2).sum(axis=2).argmin(axis=1)
    got = {r["customer_id"]: r["cluster"] for r in segments.lloyd_clusters(dm, k=4, steps=3).collect()}
    assert got == {i: c + 1 for i, c in enumerate(label.tolist())}
    assert segments.lloyd_clusters(dm.limit(0)).collect() == []
    assert {r["cluster"] for r in segments.lloyd_clusters(dm.limit(1)).collect()} == {1}


def test_rounds_that_tasks_repeat_stay_few(spark, monkeypatch):
    """A step's cost does not grow with the rounds before it, and stored labels
    give the runs that repeated rounds give."""
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=(400, 3)), 3)
    starts = [x[rng.choice(400, size=k, replace=False)] for k in (3, 6, 8) for _ in range(2)]
    blocks = kmeans.packed(_frame(spark, x), ["c0", "c1", "c2"])
    step, most = kmeans._step, []

    def counted(blocks, runs, *args):
        most.append(max(len(r.rounds or ()) for r in runs))
        return step(blocks, runs, *args)

    monkeypatch.setattr(kmeans, "_step", counted)
    monkeypatch.setattr(kmeans, "REPLAYED", 1000)
    want = kmeans.fit(blocks, starts, 4)
    assert max(most) > 1
    most.clear()
    monkeypatch.setattr(kmeans, "REPLAYED", 1)
    got = kmeans.fit(blocks, starts, 4)
    assert max(most) <= 1
    for g, w in zip(got, want):
        assert abs(g.cost - w.cost) < 1e-8 and np.allclose(g.centers, w.centers) and (g.sizes == w.sizes).all()


def test_rounds_work_on_the_rows_that_can_move(spark, monkeypatch):
    """Transfers read few rows, whatever the rows of the table."""
    rng = np.random.default_rng(9)
    x = np.vstack([rng.normal(c, 1.0, size=(2000, 3)) for c in ((0, 0, 0), (6, 0, 0), (0, 6, 0))])
    keep, shares = kmeans._kept, []

    def counted(blocks, runs, anchors, dim):
        out = keep(blocks, runs, anchors, dim)
        kept = [0] * len(runs)
        for r in out.select("kept").collect():
            for i, raw in enumerate(r["kept"]):
                kept[i] += len(kmeans.Kept.read(raw, len(runs[i].centers), dim).places)
        shares.extend(n / len(x) for n in kept)
        return out

    monkeypatch.setattr(kmeans, "_kept", counted)
    starts = [x[rng.choice(len(x), size=3, replace=False)] for _ in range(4)]
    runs = kmeans.fit(kmeans.packed(_frame(spark, x), ["c0", "c1", "c2"]), starts, 100)
    assert shares and np.mean(shares) < 0.05
    for run in runs:
        d = ((x[:, None, :] - run.centers[None]) ** 2).sum(axis=2)
        assert abs(_cost(x.tolist(), d.argmin(axis=1).tolist(), 3) - run.cost) < 1e-6


@pytest.mark.parametrize("span, least", [(0.0, 0.0), (0.5, 0.0), (3.0, 1e-3), (1e9, 1e-3), (3.0, 0.3)])
def test_reach_changes_no_run(spark, monkeypatch, span, least):
    """All rows kept, few, and runs that are settled anew all the time: the same."""
    rng = np.random.default_rng(21)
    x = np.round(rng.normal(size=(300, 3)), 2)
    x = np.vstack([x, x[:40], x[:40]])
    starts = [x[rng.choice(300, size=k, replace=False)] for k in (2, 5, 8) for _ in range(2)]
    blocks = kmeans.packed(_frame(spark, x), ["c0", "c1", "c2"])
    monkeypatch.setattr(kmeans, "LEAST_REACH", 1e12)  # nothing is settled
    want = kmeans.fit(blocks, starts, 8)
    monkeypatch.setattr(kmeans, "SPAN", span)
    monkeypatch.setattr(kmeans, "LEAST_REACH", least)
    for g, w in zip(kmeans.fit(blocks, starts, 8), want):
        assert abs(g.cost - w.cost) < 1e-8 and (g.sizes == w.sizes).all() and np.allclose(g.centers, w.centers)


def test_equal_centres_share_no_row(spark, points):
    """Rows as near to two centres belong to the first."""
    start = points[[0, 0, 20]]
    total = kmeans._step(kmeans.packed(_frame(spark, points), ["c0", "c1"]), [kmeans.Run(start)], 2)
    d = ((points[:, None, :] - start[None]) ** 2).sum(axis=2)
    label = d.argmin(axis=1)
    assert total.sizes.tolist() == [(label == j).sum() for j in range(3)] and total.sizes[1] == 0
    assert np.allclose(total.sums, [points[label == j].sum(axis=0) for j in range(3)])
