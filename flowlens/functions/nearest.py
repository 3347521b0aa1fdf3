"""Nearest centre of a vector column."""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def nearest_center(vector: Column, centers: list[list[float]]) -> Column:
    """struct<prediction, distance>: id of and Euclidean distance to the nearest centre.

    Equal distances go to the lowest id. A vector with a NaN has neither: both are null. The
    function is declared non-deterministic so that Spark never copies it into a pushed-down
    filter and evaluates it twice; filter on keys before the assignment. Only the vector column travels to the Arrow
    worker; each batch is a few array operations per centre. Written with higher-order
    functions or unrolled column arithmetic the same step is eight times slower or worse
    (see the README), because neither is compiled to a tight loop.
    """
    table = np.asarray(centers, dtype=np.float64)

    @F.arrow_udf("prediction int, distance double")
    def nearest(vectors: pa.Array) -> pa.Array:
        points = vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), table.shape[1])
        best = np.full(len(points), np.inf)
        label = np.zeros(len(points), dtype=np.int32)
        for i, center in enumerate(table):
            offset = points - center
            squared = np.einsum("ij,ij->i", offset, offset)
            closer = squared < best
            best[closer] = squared[closer]
            label[closer] = i
        unknown = np.isnan(points).any(axis=1)
        return pa.StructArray.from_arrays(
            [pa.array(label, mask=unknown), pa.array(np.sqrt(best), mask=unknown)],
            names=["prediction", "distance"])

    return nearest.asNondeterministic()(vector)


def vectors_of(column: pa.Array, width: int) -> np.ndarray:
    """An Arrow list column as one row per vector."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def closest(points: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(id, squared distance) of the nearest centre, as ``nearest_center`` finds it.

    For many centres: one matrix product gives all distances but for rounding. The bound of
    that rounding says for which rows the nearest centre is not certain; only those are
    compared centre by centre, and the distance itself is always that of the difference.
    """
    size = np.sqrt(np.einsum("ij,ij->i", points, points))
    squares = np.einsum("ij,ij->i", centers, centers)
    rough = squares[None, :] - 2 * (points @ centers.T)
    label = rough.argmin(axis=1)
    slack = 16 * points.shape[1] * np.finfo(np.float64).eps * (size + np.sqrt(squares.max())) ** 2
    least = rough[np.arange(len(points)), label]
    unsure = np.flatnonzero((rough <= (least + slack)[:, None]).sum(axis=1) != 1)
    offset = points - centers[label]
    squared = np.einsum("ij,ij->i", offset, offset)
    if len(unsure):
        exact = np.empty((len(unsure), len(centers)))
        for i, center in enumerate(centers):
            offset = points[unsure] - center
            exact[:, i] = np.einsum("ij,ij->i", offset, offset)
        label[unsure] = exact.argmin(axis=1)
        squared[unsure] = exact[np.arange(len(unsure)), label[unsure]]
    return label, squared


def squared_distance(vector: Column, centers: np.ndarray) -> Column:
    """The squared distance to the nearest of many centres; null for a vector with a NaN."""
    table = np.asarray(centers, dtype=np.float64)

    @F.arrow_udf("double")
    def squared(vectors: pa.Array) -> pa.Array:
        points = vectors_of(vectors, table.shape[1])
        unknown = np.isnan(points).any(axis=1)
        _, found = closest(np.where(unknown[:, None], 0.0, points), table)
        return pa.array(found, mask=unknown)

    return squared.asNondeterministic()(vector)
