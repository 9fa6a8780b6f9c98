"""Whitening of embeddings by the spectral components of their covariance.

Each entry c becomes the whole number ``floor(1024 * c) + 100000``. Count, sums and centred products are whole numbers
too, so they are the same for any layout and any order of the rows. The covariance alone, one matrix of the size of a
vector, reaches the driver; its components come from ``spectral`` and go back with the tasks.

* Rows whose vector is null, empty, or holds a null or non-finite entry are dropped, as are those with an entry whose
  whole number passes 2^61. All other vectors are the fit list; their lengths must agree, otherwise this is an error.
* Repeated rows count as often as they occur; ids may repeat or be null.
* Components with no variance (up to rounding) cannot be whitened and are left out: equal vectors, a single row or an
  empty table give no rows. Equal eigenvalues give some orthonormal basis of their space, the same for all rows.
* ``deviation`` is null where it does not fit into a long (vast tables); it is exact otherwise.
* Columns other than ``vec_id`` and ``embedding`` are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecflow.llm.spectral import EPSILON, eigenvectors
from vecflow.scratch import materialize

SCALE, SHIFT = 1024, 100_000
LARGEST = 2.0**61
EXACT = 1 << 53
MOST_COMPONENTS = 8
#: Rows that a task works on at a time.
ROWS = 4096


def whole_vectors(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the valid vectors in the batch, their length, and all their whole numbers one after the other."""
    vectors = batch.column("embedding")
    if not len(vectors):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    sizes = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    entries = pc.list_flatten(vectors).cast(pa.float64()).to_numpy(zero_copy_only=False)  # null becomes nan
    with np.errstate(invalid="ignore", over="ignore"):
        scaled = np.floor(entries * SCALE)
        bad = ~(np.abs(scaled) <= LARGEST)
    row = np.repeat(np.arange(len(sizes)), sizes)
    good = (sizes > 0) & (np.bincount(row[bad], minlength=len(sizes)) == 0)
    return np.flatnonzero(good), sizes[good], scaled[good[row]].astype(np.int64) + SHIFT


def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """The valid rows of each batch in blocks of equal length: (batch, places, matrix of whole numbers)."""
    for whole in batches:
        for start in range(0, whole.num_rows, ROWS):
            batch = whole.slice(start, ROWS)
            places, sizes, numbers = whole_vectors(batch)
            begins = np.cumsum(sizes) - sizes
            for size in np.unique(sizes):
                mine = sizes == size
                yield batch, places[mine], numbers[begins[mine][:, None] + np.arange(size)]


def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows and sums of each place for each length of vector, one set for the task."""
    totals: dict[int, list] = {}
    for _, places, numbers in matrices(batches):
        state = totals.setdefault(numbers.shape[1], [0, np.zeros(numbers.shape[1], object)])
        state[0] += len(places)
        state[1] += exact_sums(numbers)
    for size, (n, sums) in totals.items():
        columns = {"size": ([size] * size, pa.int32()), "i": (range(size), pa.int32()), "n": ([n] * size, pa.int64()), "total": (map(str, sums), pa.string())}
        yield pa.RecordBatch.from_pydict({name: pa.array(list(values), kind) for name, (values, kind) in columns.items()})


def exact_sums(numbers: np.ndarray) -> np.ndarray:
    """Sums of the columns as whole numbers of any size."""
    if len(numbers) and int(np.abs(numbers).max()) * len(numbers) >= EXACT:
        return numbers.astype(object).sum(axis=0)
    return numbers.sum(axis=0).astype(object)


def exact_products(numbers: np.ndarray) -> np.ndarray:
    """``numbers.T @ numbers`` as whole numbers: by floats as long as these are exact, otherwise by halves."""
    n = len(numbers)
    largest = int(np.abs(numbers).max()) if n else 0
    if largest * largest * n < EXACT:
        values = numbers.astype(float)
        return (values.T @ values).astype(np.int64).astype(object)
    if n == 1:
        values = numbers[0].astype(object)
        return np.outer(values, values)
    return exact_products(numbers[: n // 2]) + exact_products(numbers[n // 2 :])


def multiplied(centre: list[int]):
    """A function for the tasks: sums of products of vectors less a whole-number centre, one set for the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(centre)
        total, middle = np.zeros((size, size), object), np.array(centre, np.int64)
        for _, _, numbers in matrices(batches):
            total += exact_products(numbers - middle)
        i, j = np.triu_indices(size)
        columns = {"i": pa.array(i, pa.int32()), "j": pa.array(j, pa.int32()), "total": pa.array([str(v) for v in total[i, j]])}
        yield pa.RecordBatch.from_pydict(columns)

    return run


@dataclass
class Components:
    """What whitening needs: count and sums of the fit list, its covariance and the components by falling variance."""

    n: int
    sums: list[int]
    covariance: np.ndarray
    variances: np.ndarray
    vectors: np.ndarray  # as columns

    @property
    def explained(self) -> np.ndarray:
        return self.variances / np.trace(self.covariance)


def fit(embeddings: DataFrame, components: int = MOST_COMPONENTS) -> Components | None:
    """Components of all valid vectors; None where there are none or no place varies.

    Products are taken of the vectors less a whole number next to their mean, and what the mean differs from that number
    is taken off afterwards, in whole numbers. So the centring loses no bit, and the order of the rows does not matter.
    """
    rows = embeddings.select("vec_id", "embedding")
    number = F.sum(F.col("total").cast("decimal(38,0)")).cast("string").alias("total")
    parts = rows.mapInArrow(summed, "size int, i int, n bigint, total string")
    totals = parts.groupBy("size", "i").agg(F.sum("n").alias("n"), number).orderBy("size", "i").collect()
    sizes = {r["size"] for r in totals}
    if not sizes:
        return None
    if len(sizes) > 1:
        raise ValueError(f"vectors of different lengths: {sorted(sizes)}")
    n, sums = totals[0]["n"], [int(r["total"]) for r in totals]
    centre = [(2 * s + n) // (2 * n) for s in sums]
    products = rows.mapInArrow(multiplied(centre), "i int, j int, total string").groupBy("i", "j").agg(number).collect()
    rest, covariance = [s - n * m for s, m in zip(sums, centre)], np.zeros((len(sums), len(sums)))
    for i, j, total in products:
        covariance[i, j] = covariance[j, i] = (n * int(total) - rest[i] * rest[j]) / (n * n)
    if not covariance.any():
        return None
    variances, vectors = eigenvectors(covariance, components)
    real = variances > len(sums) * EPSILON * variances[0]
    return Components(n, sums, covariance, variances[real], vectors[:, real])


def whiten(embeddings: DataFrame, model: Components) -> DataFrame:
    """(vec_id, whitened, deviation) for every valid row: its components as an array."""
    n, sums = model.n, np.array(model.sums, object)
    scaled = model.vectors / np.sqrt(model.variances)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        small = max(map(abs, model.sums)) < 1 << 62
        for batch, places, numbers in matrices(batches):
            if not len(places):
                continue
            fits = small and int(np.abs(numbers).max()) * n < 1 << 62
            far = numbers * n - sums.astype(np.int64) if fits else numbers.astype(object) * n - sums
            whitened = (far / n).astype(float) @ scaled
            if fits and int(np.abs(far).max()) ** 2 * far.shape[1] < 1 << 63:
                deviation = (far * far).sum(axis=1).tolist()
            else:
                exact = (far.astype(object) ** 2).sum(axis=1)
                deviation = [int(v) if v < 1 << 63 else None for v in exact]
            offsets = pa.array(np.arange(len(places) + 1) * scaled.shape[1], pa.int32())
            columns = {
                "vec_id": batch.column("vec_id").take(pa.array(places)),
                "whitened": pa.ListArray.from_arrays(offsets, pa.array(whitened.ravel())),
                "deviation": pa.array(deviation, pa.int64()),
            }
            yield pa.RecordBatch.from_pydict(columns)

    id_type = embeddings.schema["vec_id"].dataType.simpleString()
    return embeddings.select("vec_id", "embedding").mapInArrow(run, f"vec_id {id_type}, whitened array<double>, deviation bigint")


def identity_error(whitened: DataFrame, components: int) -> float:
    """Largest absolute entry of the covariance of the whitened rows less the identity, centred before multiplying."""
    values = [F.get("whitened", F.lit(i)) for i in range(components)]
    means = whitened.agg(*[F.avg(v).alias(f"m{i}") for i, v in enumerate(values)]).first()
    pairs = [(i, j) for i in range(components) for j in range(i + 1)]
    centred = [v - F.lit(m) for v, m in zip(values, means)]
    found = whitened.agg(*[F.avg(centred[i] * centred[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(value - (i == j)) for (i, j), value in zip(pairs, found))


def whitened_components(embeddings: DataFrame, components: int = MOST_COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) for every valid row and component."""
    id_type = embeddings.schema["vec_id"].dataType.simpleString()
    model = fit(embeddings, components)
    if model is None:
        return embeddings.sparkSession.createDataFrame(
            [],
            f"vec_id {id_type}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double",
        )
    rows = materialize(whiten(embeddings, model), "whitened")
    error = identity_error(rows, len(model.variances))
    explained = F.array(*[F.lit(float(e)) for e in model.explained])
    each = rows.select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened"))
    return each.select(
        "vec_id",
        (F.col("place") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("place")).alias("explained"),
        F.lit(float(error)).alias("identity_error"),
    )
