"""Whitening of embeddings by principal components of an exact characteristic polynomial.

1. Entries become whole numbers x = floor(64 c) + 1000000. Tasks add up x and products of x
   about the offset without rounding and give limbs of 40 bits; Spark adds the limbs. The
   driver gets one row per pair of dimensions, whatever the number of vectors, and has
   n, S and the integer scatter n * sum(x x') - S S' = n^2 V exactly.
2. The characteristic polynomial of the scatter is found modulo primes, a row of Spark each,
   and joined by Chinese remaindering. Its largest roots are isolated and known to 60 digits;
   null spaces, a row of Spark each, give the components (`exact_spectrum`).
3. Vectors are projected where they lie, in batches, with n * x - S computed in whole numbers.
   A pass over the same rows adds up products of the whitened values for identity_error.

Nothing is sampled; tasks hold one batch and matrices of the size of the dimensions. What goes
to the driver and to the tasks grows with the square of the dimensions only. Cost of step 2
grows with the fourth power of the dimensions: seconds up to about a hundred of them, spread
over tasks beyond.

Defined cases: a vector that is null, empty, or holds null or non-finite entries gives no rows;
vectors of another length are a fit list of their own; 64 c beyond +-2^62 counts as that
bound; components are those of positive eigenvalue, so equal vectors, or a single one, give
no rows; where eigenvalues are equal in 60 digits their components are some orthonormal basis, the
same for all rows; repeated rows and ids count each; an empty table gives no rows; a deviation
beyond 64 bits is null; a component's sign is such that its largest entry is positive; other
columns do not matter, whatever their names.
"""

from __future__ import annotations

import decimal
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from millrace.llm import exact_spectrum as spectrum
from millrace.llm.tables import kept

COMPONENTS = 32
SCALE, OFFSET = 64, 1_000_000
LIMB_BITS = 40
LIMBS = 5  # 200 bits: squares of 2^62 times 2^70 rows
LARGEST = 2**62

MOMENT = "size int, i int, j int, " + ", ".join(f"limb{k} long" for k in range(LIMBS))
VALUES = "component int, n long, deviation long, whitened double"


@dataclass(frozen=True)
class Model:
    """Fitted on all vectors of one length. ``total`` is the sum of x - OFFSET."""

    n: int
    total: list[int]
    components: np.ndarray
    eigenvalues: list[Decimal]
    explained: list[float]


def usable(embeddings: DataFrame) -> DataFrame:
    """vec_id and v (doubles) of the vectors that take part."""
    v = embeddings["embedding"].cast("array<double>")
    rows = embeddings.select("vec_id", v.alias("v"))
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return rows.where(F.col("v").isNotNull() & (F.size("v") > 0) & finite)


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and whole entries (less OFFSET) of the vectors of each length."""
    column = batch.column("v")
    sizes = column.value_lengths().to_numpy()
    starts = column.offsets.to_numpy()[:-1] if len(column) else np.zeros(0, int)
    flat = column.values.to_numpy(zero_copy_only=False)
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        c = flat[starts[at][:, None] + np.arange(size)]
        with np.errstate(over="ignore"):
            whole = np.clip(np.floor(SCALE * c), -float(LARGEST), float(LARGEST))
        yield at, whole.astype(np.int64)


def exact_products(y: np.ndarray) -> np.ndarray:
    """y' y as Python integers; by float products of parts that cannot round."""
    largest = int(np.abs(y).max(initial=0)) if len(y) else 0
    bits = max(1, (52 - max(1, len(y)).bit_length()) // 2)
    parts, rest = [], y
    while True:
        low = rest & ((1 << bits) - 1) if largest >> bits else rest
        parts.append(low.astype(np.float64))
        if not largest >> bits:
            break
        rest, largest = rest >> bits, (largest >> bits) + 1
    out = np.zeros((y.shape[1], y.shape[1]), object)
    for a, left in enumerate(parts):
        for b, right in enumerate(parts):
            out = out + (left.T @ right).astype(np.int64).astype(object) * (1 << (bits * (a + b)))
    return out


def _limbs(value: int) -> list[int]:
    """Signed limbs, lowest first; the last takes what is left."""
    out = []
    for _ in range(LIMBS - 1):
        out.append(value & ((1 << LIMB_BITS) - 1))
        value >>= LIMB_BITS
    return [*out, value]


def moments(vectors: DataFrame) -> dict[int, tuple[int, list[int], list[list[int]]]]:
    """Length -> number of vectors, sums and products of x - OFFSET, all exact."""
    schema = T.StructType.fromDDL(MOMENT)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, y in _by_length(batch):
                # A column of ones gives the sums and the count beside the products.
                y = np.concatenate([y, np.ones((len(y), 1), np.int64)], axis=1)
                held[y.shape[1] - 1] = held.get(y.shape[1] - 1, 0) + exact_products(y)
        for size, total in held.items():
            for i in range(size + 1):
                rows = [[size, i, j, *_limbs(int(total[i, j]))] for j in range(i, size + 1)]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)

    limbs = [f"limb{k}" for k in range(LIMBS)]
    summed = vectors.select("v").mapInArrow(run, schema).groupBy("size", "i", "j").agg(*(F.sum(c).alias(c) for c in limbs))
    found: dict[int, list[list[int]]] = {}
    for r in summed.collect():  # half the square of the dimensions
        size = r["size"]
        matrix = found.setdefault(size, [[0] * (size + 1) for _ in range(size + 1)])
        value = sum(r[c] << (LIMB_BITS * k) for k, c in enumerate(limbs))
        matrix[r["i"]][r["j"]] = matrix[r["j"]][r["i"]] = value
    return {size: (m[size][size], m[size][:size], [row[:size] for row in m[:size]]) for size, m in found.items()}


def characteristic(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """Whole coefficients of det(x - matrix), constant first; a row of Spark per prime."""
    primes = spectrum.primes_for(spectrum.coefficient_bound(matrix))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for prime in batch.column("prime").to_pylist():
                rest = spectrum.polynomial_modulo(matrix, prime)
                yield pa.RecordBatch.from_pydict({"prime": [prime], "rest": [rest.tolist()]})

    rows = _spread(spark, [(p,) for p in primes], "prime long").mapInArrow(run, "prime long, rest array<long>").collect()
    return spectrum.remaindered([(r["prime"], r["rest"]) for r in rows])


def _spread(spark: SparkSession, rows: list[tuple], ddl: str) -> DataFrame:
    """Few rows with much work each, over the cores of the session."""
    parts = min(len(rows), 4 * spark.sparkContext.defaultParallelism)
    return spark.createDataFrame(rows, ddl).repartition(max(1, parts))


def eigenvectors(spark: SparkSession, matrix: list[list[int]], roots: list[tuple[Decimal, int]]) -> np.ndarray:
    """Columns are unit eigenvectors, in the order of the roots; a row of Spark per root."""
    size = len(matrix)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                basis = spectrum.null_space(matrix, Decimal(r["root"]), r["multiplicity"])
                yield pa.RecordBatch.from_pydict({"at": [r["at"]], "basis": [basis.T.reshape(-1).tolist()]})

    rows = [(k, str(root), m) for k, (root, m) in enumerate(roots)]
    made = _spread(spark, rows, "at long, root string, multiplicity int").mapInArrow(run, "at long, basis array<double>").collect()
    columns = [np.array(r["basis"]).reshape(-1, size) for r in sorted(made, key=lambda r: r["at"])]
    vectors = np.concatenate(columns).T
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
    return vectors * signs


def fit(vectors: DataFrame, components: int = COMPONENTS) -> dict[int, Model]:
    """A model for every length of ``vectors`` (see `usable`)."""
    models = {}
    for size, (n, total, products) in moments(vectors).items():
        scatter = [[n * products[i][j] - total[i] * total[j] for j in range(size)] for i in range(size)]
        trace = sum(scatter[i][i] for i in range(size))
        if not trace:
            continue
        roots = spectrum.leading_roots(characteristic(vectors.sparkSession, scatter), components, trace)
        each = [root for root, m in roots for _ in range(m)][:components]
        basis = eigenvectors(vectors.sparkSession, scatter, roots)[:, : len(each)]
        with decimal.localcontext() as context:
            context.prec = 60
            eigenvalues = [root / (n * n) for root in each]
            explained = [float(root / trace) for root in each]
        models[size] = Model(n, total, basis, eigenvalues, explained)
    return models


def _project(model: Model, y: np.ndarray) -> np.ndarray:
    """Whitened values; n * x - S is whole, and divided by n only at the end."""
    return _centred(model, y) @ (model.components / np.sqrt([float(e) for e in model.eigenvalues]))


def _centred(model: Model, y: np.ndarray) -> np.ndarray:
    """x - S/n: n * x - S is whole, rounded once to a double, then divided."""
    if _top(y) * model.n + _top(model.total) < LARGEST:
        return (model.n * y - np.array(model.total, np.int64)) / model.n
    return (model.n * y.astype(object) - np.array(model.total, object)).astype(float) / model.n


def _top(whole) -> int:
    return max(map(abs, (int(np.max(whole, initial=0)), int(np.min(whole, initial=0)))))


def deviations(model: Model, y: np.ndarray) -> list[int | None]:
    """Sum over the dimensions of (n * x - S)^2, exact; None beyond 64 bits."""
    total = np.array(model.total, object)
    if _top(y) * max(_top(y), _top(total)) * y.shape[1] < LARGEST:
        total, whole = total.astype(np.int64), y
    else:
        whole = y.astype(object)
    squares, along = (whole * whole).sum(axis=1).tolist(), (whole * total).sum(axis=1).tolist()
    of_total = sum(t * t for t in model.total)
    made = [model.n * (model.n * q - 2 * a) + of_total for q, a in zip(squares, along)]
    return [d if d < 2**63 else None for d in made]


def identity_errors(vectors: DataFrame, models: dict[int, Model]) -> dict[int, float]:
    """Length -> largest absolute entry of the whitened values' covariance minus the identity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, y in _by_length(batch):
                if y.shape[1] in models:
                    w = _project(models[y.shape[1]], y)
                    w = np.concatenate([w, np.ones((len(w), 1))], axis=1)
                    held[y.shape[1]] = held.get(y.shape[1], 0) + w.T @ w
        for size, total in held.items():
            i, j = np.triu_indices(len(total))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(i), size, np.int32)), pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])],
                ["size", "i", "j", "x"],
            )

    parts = vectors.select("v").mapInArrow(run, "size int, i int, j int, x double")
    sums: dict[int, np.ndarray] = {}
    for r in parts.groupBy("size", "i", "j").agg(F.sum("x").alias("x")).collect():
        width = len(models[r["size"]].eigenvalues) + 1
        total = sums.setdefault(r["size"], np.zeros((width, width)))
        total[r["i"], r["j"]] = total[r["j"], r["i"]] = r["x"]
    errors = {}
    for size, total in sums.items():
        n, mean = models[size].n, total[-1, :-1] / models[size].n
        # Whitened values are centred exactly but for rounding, so their own mean is near 0.
        errors[size] = float(np.abs(total[:-1, :-1] / n - np.outer(mean, mean) - np.eye(len(mean))).max())
    return errors


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error: a row per vector and component."""
    vectors = kept(usable(embeddings), "vectors")
    models = fit(vectors, components)
    errors = identity_errors(vectors, models) if models else {}
    fields = [embeddings.schema["vec_id"], *T.StructType.fromDDL(f"{VALUES}, explained double, identity_error double").fields]
    schema = T.StructType(fields)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, y in _by_length(batch):
                model = models.get(y.shape[1])
                if model is None:
                    continue
                width = len(model.eigenvalues)
                ids = batch.column("vec_id").take(pa.array(np.repeat(at, width)))
                component = np.tile(np.arange(1, width + 1, dtype=np.int32), len(at))
                deviation = pa.array(deviations(model, y), pa.int64()).take(pa.array(np.repeat(np.arange(len(at)), width)))
                yield pa.RecordBatch.from_arrays(
                    [
                        ids,
                        pa.array(component),
                        pa.array(np.full(len(component), model.n)),
                        deviation,
                        pa.array(_project(model, y).reshape(-1)),
                        pa.array(np.tile(model.explained, len(at))),
                        pa.array(np.full(len(component), errors[y.shape[1]])),
                    ],
                    schema=arrow,
                )

    return vectors.mapInArrow(run, schema)
