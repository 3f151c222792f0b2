import numpy as np

from millrace.llm import vectors


def expected(rows):
    good = {i: np.array(v, float) for i, v in rows if v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    links = {i: {j for j, b in good.items() if i != j and len(a) == len(b) and a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= 0.95} for i, a in good.items()}
    low = {i: i for i, _ in rows}
    for _ in rows:
        for i, near in links.items():
            for j in near:
                low[i] = low[j] = min(low[i], low[j])
    return sorted((i, len(links.get(i, ())), low[i], low[i] == i) for i, _ in rows)


def make(spark, rows):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<double>, label int").repartition(3)


def awkward(n=300, size=20):
    rng = np.random.default_rng(0)
    rows = []
    for i in range(n):
        base = rng.normal(size=size)
        rows.append((i, base.tolist()))
    for c in range(120):  # a large group of near copies and one of equal vectors
        rows.append((n + c, (np.array(rows[5][1]) + rng.normal(scale=0.25, size=size)).tolist()))
        rows.append((n + 200 + c, rows[6][1]))
    nan = float("nan")
    return rows + [(9000, None), (9001, []), (9002, [0.0] * size), (9003, [nan] * size), (9004, [None] * size),
                   (9005, [float("inf")] * size), (9006, [1.0, 2.0]), (9007, [2.0, 4.0]), (9008, [1e-300] * size), (9009, [2e-300] * size)]


def test_links_equal_brute_force(spark, monkeypatch):
    rows = awkward()
    plain = [(i, v) for i, v in rows if i < 9008]
    for block in (4096, 64):  # one tile, and many
        monkeypatch.setattr(vectors, "BLOCK", block)
        found = sorted(tuple(r) for r in vectors.near_duplicates(make(spark, plain)).collect())
        assert found == expected(plain)


def test_very_small_components_still_have_a_direction(spark):
    found = {r.vec_id: r.n_links for r in vectors.near_duplicates(make(spark, awkward()[-2:])).collect()}
    assert found == {9008: 1, 9009: 1}


def test_empty(spark):
    assert vectors.near_duplicates(make(spark, [])).collect() == []
    assert [tuple(r) for r in vectors.near_duplicates(make(spark, [(1, None)])).collect()] == [(1, 0, 1, True)]


def brute(rows):
    """n_links per row and component per id; rows that share an id are one node."""
    def usable(i, v):
        return i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)

    good = [(k, i, np.array(v, float)) for k, (i, v) in enumerate(rows) if usable(i, v)]
    n, low = [0] * len(rows), {i: i for i, _ in rows if i is not None}
    pairs = [
        (k, m, i, j) for k, i, a in good for m, j, b in good
        if k != m and len(a) == len(b) and a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= 0.95
    ]
    for k, _, _, _ in pairs:
        n[k] += 1
    for _ in rows:
        for _, _, i, j in pairs:
            low[i] = low[j] = min(low[i], low[j])
    return sorted(((i, n[k], low.get(i), i is None or low[i] == i) for k, (i, _) in enumerate(rows)), key=repr)


def test_repeated_ids_null_ids_and_clashing_names(spark):
    from pyspark.sql import functions as F

    rows = [(1, [1.0, 0.0, 0.0]), (1, [0.0, 1.0, 0.0]), (2, [1.0, 0.01, 0.0]), (3, [1.0, 0.02, 0.0]), (4, [0.0, 1.0, 0.01]),
            (4, [0.0, 0.0, 1.0]), (5, [0.0, 0.01, 1.0]), (5, [0.0, 0.01, 1.0]), (None, [1.0, 0.0, 0.0]), (6, None), (7, [-1.0, 0.0, 0.0])]
    names = ("v", "n", "at", "block", "first", "direction", "other", "a", "b", "node", "component")
    df = make(spark, rows).select("*", *(F.lit("own").alias(c) for c in names))
    found = sorted((tuple(r) for r in vectors.near_duplicates(df).collect()), key=repr)
    assert found == brute(rows)


def test_both_bounds_of_wide_vectors_and_memory_of_a_tile(spark):
    import tracemalloc

    rng = np.random.default_rng(4)
    wide = rng.normal(size=(40, 64))
    rows = [(i, (wide[i % 40] + rng.normal(scale=0.15, size=64)).tolist()) for i in range(160)]
    assert sorted((tuple(r) for r in vectors.near_duplicates(make(spark, rows)).collect()), key=repr) == brute(rows)
    near = rng.normal(size=1024) + rng.normal(scale=0.05, size=(512, 1024))
    axes = np.linalg.qr(rng.normal(size=(1024, 1024)))[0]
    tracemalloc.start()
    x, _ = vectors.linked(near, near, axes, 0.95, True)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(x) == 512 * 511 // 2 and peak < 600e6
