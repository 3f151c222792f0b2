"""Near-duplicates among embeddings: PCA-ordered tiled comparison.

Vectors are scaled to length one and turned so that their coordinates are principal
components, largest first (the moments are summed in Spark; the driver holds one matrix of
dimensions squared). They are cut into blocks along the first component. A tile is a pair of
blocks; a pair of blocks that lie too far apart on that component is left out, since there no
cosine can reach the threshold. Inside a tile the first coordinates are multiplied for all
pairs at once; what the rest can add is at most the product of the norms of the rest. Pairs
that can still reach the threshold go on to the next coordinates, and those left at the end
are computed from the vectors as given, in double precision, which decides.

A tile gives a number of links per vector and a forest of its links, never the pairs.
Equal vectors are merged first and counted.

Defined cases: a vector that is null, empty, zero or holds null, NaN or infinity links with
nothing; vectors of another length than most are compared among themselves; a vec_id that
occurs twice is one node, each of its rows is compared and returned with the links of its own
vector; a row without an id links with nothing; other columns do not matter, whatever their
names; an empty table gives no rows. The work grows with the square of the number of vectors when the first component does
not separate them.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.links import components, forest
from millrace.llm.tables import kept

THRESHOLD = 0.95
BLOCK = 4096
#: Coordinates multiplied for all pairs, then for those left, before the exact cosine.
STEPS = (16, 16)
TILE = 512
#: Numbers of pairs of vectors that are held beside one another.
PAIR_NUMBERS = 1 << 21
#: Room for rounding in the turned coordinates.
SLACK = 1e-9


def _usable(embeddings: DataFrame) -> DataFrame:
    """vec_id and v (array of doubles) of the vectors that can link."""
    v = F.col("embedding").cast("array<double>")
    odd = F.exists(
        v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    )
    return (
        embeddings.select("vec_id", v.alias("v"))
        .where(F.col("v").isNotNull() & F.col("vec_id").isNotNull())
        .where(~odd & F.exists("v", lambda x: x != 0))
    )


def unit(vectors: np.ndarray) -> np.ndarray:
    # Scaled by the largest component first, so that squares neither overflow nor vanish.
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def principal_axes(vectors: DataFrame, size: int) -> np.ndarray:
    """Columns are the principal axes about the origin, largest first."""

    def moments(batches):
        total = np.zeros((size, size))
        for pdf in batches:
            if len(pdf):
                x = unit(np.stack(pdf["v"].to_numpy()))
                total += x.T @ x
        yield pd.DataFrame({"i": np.arange(size), "row": list(total)})

    parts = vectors.select("v").mapInPandas(moments, "i int, row array<double>")
    sums = parts.select("i", F.posexplode("row").alias("j", "x")).groupBy("i", "j").agg(F.sum("x").alias("x"))
    matrix = np.zeros((size, size))
    for r in sums.collect():  # dimensions squared
        matrix[r["i"], r["j"]] = r["x"]
    return np.linalg.eigh(matrix)[1][:, ::-1].copy()


def linked(a: np.ndarray, b: np.ndarray, axes: np.ndarray, threshold: float, same: bool):
    """Index pairs of rows of ``a`` and ``b`` (``same``: first below second) that link."""
    ua, ub = unit(a), unit(b)
    ta, tb = ua @ axes, ub @ axes
    head = STEPS[0]
    ends = head + np.cumsum(STEPS[1:])
    # What is left beyond each step, once per vector.
    rests_a, rests_b = ([np.sqrt((t[:, at:] ** 2).sum(axis=1)) for at in (head, *ends)] for t in (ta, tb))
    rest_a, rest_b = rests_a[0], rests_b[0]
    low = threshold - SLACK
    found = []
    for i in range(0, len(a), TILE):
        for j in range(i if same else 0, len(b), TILE):
            part = ta[i : i + TILE, :head] @ tb[j : j + TILE, :head].T
            can = part + rest_a[i : i + TILE, None] * rest_b[None, j : j + TILE] >= low
            if same and i == j:
                can = np.triu(can, 1)
            x, y = np.nonzero(can)
            if not len(x):
                continue
            # Few pairs at a time: each takes a copy of both its vectors.
            few = max(1, PAIR_NUMBERS // a.shape[1])
            for k in range(0, len(x), few):
                p, q = x[k : k + few] + i, y[k : k + few] + j
                so_far, at = part[p - i, q - j], head
                for step, to in enumerate(ends, 1):
                    so_far = so_far + np.einsum("ij,ij->i", ta[p, at:to], tb[q, at:to])
                    on = so_far + rests_a[step][p] * rests_b[step][q] >= low
                    p, q, so_far, at = p[on], q[on], so_far[on], to
                on = (ua[p] * ub[q]).sum(axis=1) >= threshold
                if on.any():
                    found.append((p[on], q[on]))
    if not found:
        return np.zeros(0, int), np.zeros(0, int)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _compare(axes: np.ndarray, threshold: float):
    def run(key, tile):
        def rows(pdf):
            return pdf["vec_id"].to_numpy(), pdf["n"].to_numpy(), np.stack(pdf["v"].to_numpy())

        none = pd.DataFrame({"vec_id": [], "other": [], "n": []}, dtype="int64")
        same = key[0] == key[1]
        left, right = tile[~tile["other_side"]], tile if same else tile[tile["other_side"]]
        if not len(left) or not len(right):
            return none
        a_id, a_n, a = rows(left)
        b_id, b_n, b = rows(right)
        x, y = linked(a, b, axes, threshold, same)
        if not len(x):
            return none
        n = pd.concat(
            [pd.Series(b_n[y]).groupby(a_id[x]).sum(), pd.Series(a_n[x]).groupby(b_id[y]).sum()]
        )
        tree, root = forest(a_id[x], b_id[y])
        return pd.DataFrame(
            {
                "vec_id": np.concatenate([n.index.to_numpy(), tree]),
                "other": np.concatenate([np.full(len(n), -1), root]),
                "n": np.concatenate([n.to_numpy(), np.zeros(len(tree), int)]),
            }
        )

    return run


def _tiles_of(merged: DataFrame, size: int, threshold: float) -> DataFrame:
    """Links per vector (other -1) and forest links of all tiles of vectors of one length."""
    axes = principal_axes(merged, size)

    def place(batches):
        for pdf in batches:
            if len(pdf):
                yield pdf.assign(at=unit(np.stack(pdf["v"].to_numpy())) @ axes[:, 0])

    ranked = kept(merged.mapInPandas(place, "v array<double>, vec_id long, n long, at double"), "placed")
    n_blocks = max(1, math.ceil(merged.count() / BLOCK))
    steps = [i / n_blocks for i in range(1, n_blocks)]
    cuts = ranked.agg(F.percentile_approx("at", steps, 10000)).first()[0] if steps else []
    cuts = sorted(set(cuts))
    block = F.lit(0)
    if cuts:
        # The sum of a block's members stays near BLOCK; vectors that tie on a cut share one.
        block = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c < F.col("at")))
    # Blocks with many ties on the first component are cut again by a hash.
    sized = kept(ranked.withColumn("slab", block), "vectors")
    slabs = sized.groupBy("slab").agg(F.count("*").alias("rows"), F.min("at").alias("low"), F.max("at").alias("high")).orderBy("slab").collect()
    blocks = []  # (slab, part, parts, low, high): a row per BLOCK vectors
    for s in slabs:
        parts = math.ceil(s["rows"] / (2 * BLOCK))
        blocks += [(s["slab"], p, parts, s["low"], s["high"]) for p in range(parts)]
    far = math.sqrt(2 - 2 * threshold) + 1e-6  # distance of unit vectors at the threshold
    first_of, tiles = {}, []
    for k, b in enumerate(blocks):
        first_of.setdefault(b[0], k)
        tiles += [(k, m) for m in range(k, len(blocks)) if blocks[m][3] - b[4] <= far]
    spark = merged.sparkSession
    sides = [(m, k, m, True) for k, m in tiles if k != m] + [(k, k, m, False) for k, m in tiles]
    pairs = spark.createDataFrame(sides, "block int, left_block int, right_block int, other_side boolean")
    begin = F.create_map(*(F.lit(x) for slab, k in first_of.items() for x in (slab, k)))
    parts = F.create_map(*(F.lit(x) for b in blocks for x in (b[0], b[2]) if b[1] == 0))
    placed = sized.select(
        "vec_id", "n", "v",
        (begin[F.col("slab")] + F.pmod(F.xxhash64("vec_id"), parts[F.col("slab")]).cast("int")).alias("block"),
    )
    return placed.join(pairs, "block").groupBy("left_block", "right_block").applyInPandas(
        _compare(axes, threshold), "vec_id long, other long, n long"
    )


def near_duplicates(embeddings: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id and kept, one row per row of ``embeddings``."""
    good = _usable(embeddings)
    # Equal directions stored alike are one, with a number of its own: an id may have several.
    directions = good.groupBy("v").agg(F.min("vec_id").alias("first"), F.count("*").alias("n"))
    merged = kept(directions.withColumn("vec_id", F.monotonically_increasing_id()), "merged")
    sizes = [r[0] for r in merged.select(F.size("v")).distinct().collect()]
    found = None
    for size in sizes:
        part = _tiles_of(merged.where(F.size("v") == size).drop("first"), size, threshold)
        found = part if found is None else found.union(part)
    if found is None:
        return embeddings.select(
            "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept")
        )
    found = kept(found, "tiles")
    links = found.where("other < 0").groupBy("vec_id").agg(F.sum("n").alias("linked"))
    counted = merged.join(links, "vec_id", "left").select(
        F.col("vec_id").alias("direction"),
        "first",
        (F.col("n") - 1 + F.coalesce("linked", F.lit(0))).cast("long").alias("n_links"),
    )
    counted = kept(counted, "counted")
    # Without an id a row is on its own, whatever its vector.
    v = F.when(F.col("vec_id").isNotNull(), F.col("embedding").cast("array<double>"))
    of = merged.select("v", F.col("vec_id").alias("direction"))
    rows = kept(embeddings.select("vec_id", v.alias("v")).join(of, "v", "left").select("vec_id", "direction"), "rows")
    marked = rows.join(counted, "direction", "left")
    # Between directions the links go by the first id of each, and from there to its other ids.
    first = counted.select("direction", "first")
    tree = found.where("other >= 0").select(F.col("vec_id").alias("a"), F.col("other").alias("b"))
    tree = tree.join(first.toDF("a", "first_a"), "a").join(first.toDF("b", "first_b"), "b")
    edges = tree.select(F.col("first_a").alias("a"), F.col("first_b").alias("b")).where("a <> b").union(
        marked.where("vec_id <> first").select(F.col("vec_id").alias("a"), F.col("first").alias("b"))
    )
    roots = components(edges)
    return (
        marked.join(roots, F.col("vec_id") == F.col("node"), "left")
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            F.coalesce("component", "vec_id").alias("component_id"),
        )
        .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
    )


ORACLE = """
with recursive usable as (
  select vec_id, embedding::double[] as v from embeddings
  where len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0
), links as (
  select a.vec_id as a, b.vec_id as b from usable a join usable b
    on a.vec_id <> b.vec_id and len(a.v) = len(b.v) and list_cosine_similarity(a.v, b.v) >= 0.95
), reach as (
  select vec_id as a, vec_id as b from embeddings
  union
  select r.a, l.b from reach r join links l on r.b = l.a
), least as (select a, min(b) as component_id from reach group by a),
counts as (select a, count(*) as n from links group by a)
select e.vec_id, coalesce(n, 0)::bigint as n_links, component_id, e.vec_id = component_id as kept
from embeddings e join least on e.vec_id = least.a left join counts on e.vec_id = counts.a
"""
