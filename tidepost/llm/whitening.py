"""Whitening of embeddings: covariance of distinct vectors weighted by how often they occur.

Equal vectors are one row with a count. Sums are exact integers, the covariance is a weighted product
of centred rows, added up over partitions; only figures of the size of the dimensions reach the
driver. Every distinct vector is whitened once and its result joined back to the rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepost.llm.common import bounded_batches, save

#: Components are integers of at most this size, which doubles hold exactly.
LARGEST = 2**52
#: An eigenvalue below this share of the trace has no direction of its own.
FLAT = 1e-13
_SAFE = 2**62


def grid(vector: Column, scale: float, offset: int) -> Column:
    """Components as whole numbers: ``floor(scale * c) + offset``, within ``LARGEST``."""
    low, high = F.lit(-LARGEST), F.lit(LARGEST)

    def whole(c: Column) -> Column:
        return F.floor(F.greatest(F.least(c * F.lit(float(scale)), high), low)).cast("long") + offset

    return F.transform(vector, whole)


def usable(rows: DataFrame) -> DataFrame:
    """``vec_id, vector`` (doubles) of vectors without null or non-finite components.

    Vectors of another length than the most frequent one (the longer of equally frequent ones) do
    not fit into one covariance and take no part, nor do vectors without components.
    """
    vector = F.col("embedding").cast("array<double>")
    finite = F.forall(
        vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))
    )
    good = rows.select("vec_id", vector.alias("vector")).filter(finite & (F.size(vector) > 0))
    sizes = good.groupBy(F.size("vector").alias("size")).agg(F.count("*").alias("n"))
    most = sizes.orderBy(F.desc("n"), F.desc("size")).limit(1).first()
    return good.filter(F.size("vector") == (most["size"] if most else 0))


def matrix(column: pa.Array) -> np.ndarray:
    """The lists of a column, all of one length, as rows of a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def weighted_sums(distinct: DataFrame) -> tuple[int, np.ndarray]:
    """Number of vectors and exact sum of each component, from ``x, weight``."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = 0, None
        for batch in batches:
            x, w = matrix(batch.column(0)), batch.column(1).to_numpy()
            if not len(x):
                continue
            if int(np.abs(x).max()) * int(w.sum()) >= _SAFE:
                x, w = x.astype(object), w.astype(object)
            part = (w @ x).astype(object)
            count, total = count + int(w.sum()), part if total is None else total + part
        if total is not None:
            sums = [str(count), *map(str, total)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(sums), dtype=np.int32)), pa.array(sums)], ["place", "total"]
            )

    parts = distinct.select("x", "weight").mapInArrow(add, "place int, total string")
    whole = parts.groupBy("place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    sums = [int(r.total) for r in whole.orderBy("place").collect()]
    return (sums[0], np.array(sums[1:], dtype=object)) if sums else (0, np.zeros(0, dtype=object))


def weighted_covariance(distinct: DataFrame, count: int, sums: np.ndarray) -> np.ndarray:
    """Covariance, divisor ``count``, of rows ``x`` that occur ``weight`` times each."""
    mean = np.array([s / count for s in sums])

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(mean), len(mean)))
        for batch in batches:
            if len(batch):
                centred = matrix(batch.column(0)) - mean
                total += (centred * batch.column(1).to_numpy()[:, None]).T @ centred
        if total.any():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(total.size, dtype=np.int32)), pa.array(total.ravel())],
                ["place", "total"],
            )

    parts = distinct.select("x", "weight").mapInArrow(multiply, "place int, total double")
    out = np.zeros(len(mean) ** 2)
    for row in parts.groupBy("place").agg(F.sum("total").alias("total")).collect():
        out[row.place] = row.total
    out = out.reshape(len(mean), -1) / count
    return (out + out.T) / 2


def deviations(x: np.ndarray, count: int, sums: np.ndarray) -> list[int | None]:
    """Exact sums of ``(count * x - sums) ** 2``; None where a long can't hold it."""
    reach = max(abs(count * int(x.max())), abs(count * int(x.min()))) + max(map(abs, sums))
    if reach**2 * x.shape[1] < _SAFE:
        off = count * x - sums.astype(np.int64)
        return (off * off).sum(axis=1).tolist()
    off = x.astype(object) * count - sums
    return [int(v) if v < 2**63 else None for v in (off * off).sum(axis=1)]


def whiten(
    rows: DataFrame,
    components: int = 8,
    scale: float = 1024,
    offset: int = 100_000,
    multiplicity: bool = True,
) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` for every vector.

    Vectors (``usable``) become whole numbers (``grid``). The fit list is all of them, or with
    ``multiplicity=False`` every distinct one once; ``n``, means and covariances follow that list.
    Components are unit eigenvectors of the covariance by falling eigenvalue, at most as many as
    there are dimensions. ``whitened`` is the centred vector's projection over the root of the
    eigenvalue, null for a component without variance (all rows equal, or fewer rows than
    dimensions). ``deviation`` is the exact sum of ``(n * x - sums) ** 2``, null beyond a long.
    ``identity_error`` is the largest distance between the covariance of ``whitened`` and the
    identity, over the components that have variance, null if none has. Rows that repeat a vector
    or an id have a result each, a null id is kept, an empty table gives no rows, other columns
    play no part. Equal vectors are counted before they are shuffled.
    """
    spark = rows.sparkSession
    bounded_batches(spark, rows=5_000)
    key = F.sha2(F.array_join(F.col("x").cast("array<string>"), ","), 256).alias("key")
    numbers = usable(rows).select("vec_id", grid(F.col("vector"), scale, offset).alias("x"))
    weight = F.count("*") if multiplicity else F.max(F.lit(1).cast("long"))
    distinct = save(
        numbers.groupBy("x").agg(weight.alias("weight")).select("x", "weight", key),
        "whitening-distinct",
    )
    schema = "key string, deviation bigint, whitened array<double>"
    count, sums = weighted_sums(distinct)
    if not count:
        return spark.createDataFrame(
            [],
            "vec_id bigint, component int, n bigint, deviation bigint, whitened double, "
            "explained double, identity_error double",
        )
    covariance = weighted_covariance(distinct, count, sums)
    trace = float(np.trace(covariance))
    values, vectors = np.linalg.eigh(covariance)
    kept = min(components, len(sums))
    values, vectors = values[::-1][:kept], vectors[:, ::-1][:, :kept]
    wide = [bool(trace > 0 and v > FLAT * trace) for v in values]
    mean = np.array([s / count for s in sums])
    project = vectors / np.sqrt(np.where(wide, values, 1.0))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            x = matrix(batch.column(1))
            out = (x - mean) @ project
            lists = [[v if w else None for v, w in zip(r, wide, strict=True)] for r in out.tolist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(deviations(x, count, sums), pa.int64()),
                    pa.array(lists, pa.list_(pa.float64())),
                ],
                ["key", "deviation", "whitened"],
            )

    results = save(distinct.select("key", "x").mapInArrow(apply, schema), "whitening-results")
    error = identity_error(results.join(distinct.select("key", "weight"), "key"), wide)
    explained = [float(v / trace) if trace > 0 else None for v in values]
    shares = F.array(*[F.lit(v).cast("double") for v in explained])
    return (
        numbers.select("vec_id", key)
        .join(results, "key")
        .select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened"))
        .select(
            "vec_id",
            (F.col("place") + 1).cast("int").alias("component"),
            F.lit(count).cast("long").alias("n"),
            "deviation",
            "whitened",
            F.get(shares, F.col("place")).alias("explained"),
            F.lit(error).cast("double").alias("identity_error"),
        )
    )


def identity_error(results: DataFrame, wide: list[bool]) -> float | None:
    """Largest entry of the covariance of ``whitened`` (``weight`` times each) minus identity."""
    at = [i for i, w in enumerate(wide) if w]
    if not at:
        return None
    value = {i: F.col("whitened")[i] for i in at}
    weight = F.col("weight")
    means = results.agg(F.sum(weight).alias("n"), *[F.sum(value[i] * weight).alias(f"m{i}") for i in at])
    means = means.first()
    off = {i: value[i] - F.lit(means[f"m{i}"] / means["n"]) for i in at}
    pairs = [(i, j) for i in at for j in at if i <= j]
    sums = results.agg(*[F.sum(off[i] * off[j] * weight).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(sums[f"c{i}_{j}"] / means["n"] - (i == j)) for i, j in pairs)
