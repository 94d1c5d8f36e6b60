import numpy as np

from tests.llm.helpers import clashing
from vigilo.llm import embedding_dedup, hnsw

ROWS = "vec_id long, embedding array<float>, label int"


def vectors(seed=0, n=90, dim=12):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, dim)).astype(np.float32)
    for k in range(n // 3):
        x[2 * k + 1] = x[2 * k] + rng.standard_normal(dim).astype(np.float32) * 0.12
    x[10:16] = x[10]
    rows = [(k, [float(v) for v in x[k]], int(k % 3 if k < 60 else 7)) for k in range(n)]
    nan, inf = float("nan"), float("inf")
    rows += [(5200, None, 1), (5201, [], 1), (5202, [0.0] * dim, 1), (5203, [nan] + [1.0] * (dim - 1), 1), (5204, [inf] + [1.0] * (dim - 1), 1),
             (5205, [None] + [1.0] * (dim - 1), 1), (5206, rows[1][1], None), (5207, [1.0, 2.0], 1), (5208, [2.0, 4.0], 1), (None, rows[1][1], 1),
             (5209, [float(v) * 1e30 for v in x[1]], 1), (5210, [float(v) * 1e-30 for v in x[1]], 1), (1, rows[1][1], 1)]
    return rows


def fine(v):
    return bool(v) and all(c is not None and np.isfinite(c) for c in v) and any(v)


def cosine(a, b):
    a, b = np.array(a, float), np.array(b, float)
    return a @ b / (np.linalg.norm(a) * np.linalg.norm(b))


def brute_links(rows, threshold=0.93):
    links = [set() for _ in rows]
    for i, (p, v, lab) in enumerate(rows):
        for j, (q, w, other) in enumerate(rows):
            if i != j and None not in (p, q, lab) and lab == other and fine(v) and fine(w) and len(v) == len(w) and cosine(v, w) >= threshold:
                links[i].add(j)
    return links


def check(spark, rows):
    got = embedding_dedup.near_duplicates(clashing(spark.createDataFrame(rows, ROWS)), "vec_id", "embedding", "label").collect()
    links = brute_links(rows)
    low = [r[0] for r in rows]
    for _ in rows:
        for i, own in enumerate(links):
            for j in own:
                low[i] = low[j] = min(low[i], low[j])
    for _ in rows:  # rows of one id are one vertex
        by = {}
        for r, c in zip(rows, low, strict=True):
            if r[0] is not None:
                by[r[0]] = min(by.get(r[0], c), c)
        low = [by.get(r[0]) if r[0] is not None else None for r in rows]
        for i, own in enumerate(links):
            for j in own:
                low[i] = low[j] = min(low[i], low[j])
    want = sorted(str((r[0], len(own), c, r[0] is not None and r[0] == c)) for r, own, c in zip(rows, links, low, strict=True))
    assert sorted(str((r.vec_id, r.n_links, r.component_id, r.kept)) for r in got) == want


def test_links_match_brute_force(spark):
    check(spark, vectors())


def test_many_blocks_give_the_same_links(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 4)
    check(spark, vectors(3))


def test_error_bound_holds():
    rng = np.random.default_rng(5)
    x = rng.standard_normal((300, 64)) * rng.exponential(1, (300, 64))
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    codes, scale, err = embedding_dedup.quantise(unit)
    near = (codes.astype(float) @ codes.astype(float).T) * scale[:, None] * scale
    assert (np.abs(near - unit @ unit.T) <= err[:, None] + err + err[:, None] * err + 1e-12).all()


def test_search_recall_and_order(spark):
    rows = vectors(7, 600, 16)
    df = clashing(spark.createDataFrame(rows, ROWS))
    index = hnsw.build_index(df, "vec_id", "embedding", 11)
    asked = df.where("vec_id % 10 = 0 or vec_id >= 5200")
    got = hnsw.nearest(asked, index, "vec_id", "embedding", 10).collect()
    good = {r[0]: [float(np.float32(c)) for c in r[1]] for r in rows if r[0] is not None and fine(r[1])}
    hits = total = 0
    by = {}
    for r in got:
        by.setdefault(r.query_id, []).append((r.rank, r.score, r.vec_id))
    queries = {r.vec_id for r in asked.collect() if r.vec_id in good}
    assert set(by) == {q for q in queries if sum(len(v) == len(good[q]) for v in good.values()) > 1}
    for q, found in by.items():
        found.sort()
        same = [(float(np.linalg.norm(np.array(v) - np.array(good[q]))), i) for i, v in good.items() if i != q and len(v) == len(good[q])]
        want = sorted(same)[:10]
        assert [r for r, *_ in found] == list(range(1, len(want) + 1))
        assert [(s, i) for _, s, i in found] == sorted((s, i) for _, s, i in found) and q not in {i for *_, i in found}
        exact = dict((i, d) for d, i in same)
        assert all(abs(exact[i] - s) <= 1e-9 * max(1.0, exact[i]) for _, s, i in found)
        hits += len({i for _, i in want} & {i for *_, i in found})
        total += len(want)
    assert hits / total >= 0.95


def brute_nearest(points, q, k):
    """``points``: id to vector; ties by id."""
    ids = np.array(sorted(i for i in points if i != q))
    apart = np.array([points[i] for i in ids]) - points[q]
    dist = np.sqrt(np.einsum("nd,nd->n", apart, apart))
    order = np.lexsort((ids, dist))[:k]
    return [(int(i), float(d)) for i, d in zip(ids[order], dist[order], strict=True)]


def found_by(spark, points, asked, k=10):
    df = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in points.items()], "vec_id long, embedding array<double>")
    index = hnsw.build_index(df, "vec_id", "embedding", k + 1)
    by = {}
    for r in hnsw.nearest(df.where(asked), index, "vec_id", "embedding", k).orderBy("query_id", "rank").collect():
        by.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return by


def recall(points, by, k=10):
    return np.mean([len({i for i, _ in brute_nearest(points, q, k)} & {i for i, _ in found}) / k for q, found in by.items()])


def test_near_copies_in_several_shards(spark, monkeypatch):
    monkeypatch.setattr(hnsw, "SHARD", 512)
    monkeypatch.setattr(hnsw, "QUERIES", 64)
    rng = np.random.default_rng(11)
    for spread in (1e-4, 1e-7):
        base = rng.standard_normal((10, 24))
        points = {g * 200 + j: base[g] * (1 + g) + rng.standard_normal(24) * spread for g in range(10) for j in range(200)}
        by = found_by(spark, points, "vec_id % 10 = 0")
        assert len(by) == 200 and all(len(v) == 10 for v in by.values())
        assert recall(points, by) >= 0.95


def test_ties_across_the_cut_go_to_smaller_ids(spark):
    # Unit vectors around the origin's neighbour: 40 points at exactly the same distance of the query.
    points = {1000: np.full(40, 4.0)}
    for k in range(40):
        v = np.full(40, 4.0)
        v[k] += 2.0
        points[900 - 7 * k] = v
    by = found_by(spark, points, "vec_id = 1000")
    assert by[1000] == brute_nearest(points, 1000, 10) and {d for _, d in by[1000]} == {2.0}


def test_query_far_longer_than_a_shard(spark):
    rng = np.random.default_rng(2)
    points = {k: rng.standard_normal(8) for k in range(50)} | {99: rng.standard_normal(8) * 1e30}
    by = found_by(spark, points, "vec_id = 99")
    assert len(by[99]) == 10


def test_empty_tables(spark):
    none = spark.createDataFrame([], ROWS)
    assert embedding_dedup.near_duplicates(none, "vec_id", "embedding", "label").count() == 0
    assert hnsw.nearest(none, hnsw.build_index(none, "vec_id", "embedding", 11), "vec_id", "embedding").count() == 0
