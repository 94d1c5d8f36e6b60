import numpy as np
from pyspark.sql import functions as F

from vigilo.operators import balance
from vigilo.operators.nearest import nearest_vectors

C = F.col


def brute_nearest(points, k):
    x = np.array(points, dtype=float)
    span = x.max(0) - x.min(0)
    z = x / np.where(span > 0, span, np.inf)
    out = {}
    for i, p in enumerate(z):
        far = np.sqrt(((z - p) ** 2).sum(1))
        order = sorted((j for j in range(len(x)) if j != i), key=lambda j: (far[j], tuple(x[j])))[:k]
        out[tuple(x[i])] = [(round(far[j], 9), tuple(x[j])) for j in order]
    return out


def check_nearest(spark, points, k, **options):
    df = spark.createDataFrame([(list(map(float, p)), 1) for p in points], "vec array<double>, n long")
    got = {tuple(r["vec"]): [(round(s["distance"], 9), tuple(s["vec"])) for s in r["near"]] for r in nearest_vectors(df, k, **options).collect()}
    assert got == brute_nearest(points, k)


def test_nearest_is_exact_across_cells_and_blocks(spark):
    rng = np.random.default_rng(6)
    points = sorted({tuple(np.round(p, 2)) for p in np.vstack([rng.normal(size=(150, 3)), rng.normal(size=(60, 3)) / 20 + 3])})
    check_nearest(spark, points, 5, cell_rows=25)
    check_nearest(spark, points, 5)


def test_nearest_with_ties_and_few_points(spark):
    grid = [(i, j) for i in range(6) for j in range(6)]
    check_nearest(spark, grid, 4, cell_rows=7)
    check_nearest(spark, [(0, 0), (1, 5), (2, 2)], 5)
    check_nearest(spark, [(1, 2)], 5)


def frame(spark):
    rng = np.random.default_rng(8)
    rows = [(i, float(a), float(b), 0) for i, (a, b) in enumerate(rng.normal(size=(90, 2)))]
    rows += [(100 + i, float(a), float(b), 1) for i, (a, b) in enumerate(rng.normal(size=(12, 2)) + 2)]
    rows += [(200 + i, 9.0, 9.0, 1) for i in range(6)]
    return spark.createDataFrame(rows, "id int, a double, b double, y int")


def test_smote_sizes_and_segments(spark):
    df = frame(spark)
    out = balance.smote(df, ["a", "b"], "y", "id", minority=1)
    n = {r["source"]: r["count"] for r in out.groupBy("source").count().collect()}
    assert n == {"minority": 18, "synthetic": 36, "majority": 72}
    rare = sorted({(r["a"], r["b"]) for r in df.where("y = 1").collect()})
    near = brute_nearest(rare, 5)
    segments = [(np.array(p), np.array(q)) for p, qs in near.items() for _, q in qs] + [(np.array(p), np.array(p)) for p in rare]
    for r in out.where("source = 'synthetic'").collect():
        x = np.array([r["a"], r["b"]])
        assert min(abs(np.linalg.norm(x - p) + np.linalg.norm(x - q) - np.linalg.norm(p - q)) for p, q in segments) < 1e-9
    # Copies of one row are each other's nearest neighbours: nothing is made between them.
    assert out.where("source = 'synthetic' AND a = 9 AND b = 9").count() == 12
    common = {(r["a"], r["b"]) for r in df.where("y = 0").collect()}
    assert all((r["a"], r["b"]) in common for r in out.where("source = 'majority'").collect())
    again = balance.smote(df, ["a", "b"], "y", "id", minority=1)
    assert out.exceptAll(again).count() == 0


def test_up_and_downsample_are_exact(spark):
    df = frame(spark)
    up = balance.upsample(df, "y", "id")
    assert {r["y"]: r["count"] for r in up.groupBy("y").count().collect()} == {0: 90, 1: 90}
    assert up.where("copy = 0").count() == 108
    down = balance.downsample(df, "y", "id")
    assert {r["y"]: r["count"] for r in down.groupBy("y").count().collect()} == {0: 18, 1: 18}
    assert down.select("id").distinct().count() == 36


def test_move_class(spark):
    df = spark.createDataFrame([(2,), (3,)], "m int")
    assert [r["class"] for r in balance.move_class(df, "m").orderBy("m").collect()] == ["NoMove", "Move"]


def test_a_vector_is_sent_to_the_cells_it_can_reach_only(spark, monkeypatch):
    from vigilo.operators import nearest

    rng = np.random.default_rng(11)
    points = sorted({tuple(p) for p in rng.random((800, 2))})
    sizes, real = {}, nearest.stage

    def counted(df, label):
        out = real(df, label)
        sizes[label] = out.count()
        return out

    monkeypatch.setattr(nearest, "stage", counted)
    check_nearest(spark, points, 4, cell_rows=20)
    # 40 cells: the balls of four neighbours reach a few each.
    assert sizes["sent"] < 3 * len(points)
