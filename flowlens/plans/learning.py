"""Train a detector from connection features."""

from pyspark.sql import DataFrame

from flowlens.operators.boundaries import check_percentile, cluster_boundaries
from flowlens.operators.clustering import (
    Clusters, assign, first_centers, fit_clusters, refine_centers,
)
from flowlens.operators.detector import Detector, new_version
from flowlens.operators.scaling import fit_scaler, standardize
from flowlens.sinks.tables import write_table
from flowlens.workspace import exists, remove, work_path


def detector_path(root: str, k: int, percentile: int) -> str:
    return f"{root.rstrip('/')}/detector_k{k}_p{percentile}"


def distances_table(scored: DataFrame) -> DataFrame:
    """Scored rows under the stored table's names."""
    return scored.withColumnsRenamed({"prediction": "predictions", "distance": "distances"})


def run_path(path: str, version: str) -> str:
    """Where a version's distances and Spark ML model are."""
    return f"{path.rstrip('/')}/runs/{version}"


def train(table: DataFrame, k: int, percentile: int, root: str | None = None,
          mode: str = "errorifexists", steps: int | None = None, seed: int = 1234,
          max_iter: int = 100, boundary_method: str = "exact") -> Detector:
    """Scale, cluster, measure distances, take each cluster's percentile, and save.

    ``table`` has keys and counters and should be a stored training set: it is read once
    for the scaler, once for the fit (once per step with ``steps``) and once for the
    distances. With ``root`` the detector is stored below ``detector_path(root, k,
    percentile)``, its Spark ML model and distances table below ``run_path`` of that. The
    detector is saved last and as one commit, so a training run that fails leaves the
    version before it in use. With ``steps`` the centres start at the first k rows and
    take that many steps, which repeats exactly.

    The boundaries are taken from the stored distances, so the assignment is never computed
    twice and a lost executor costs re-reads only. Without ``root`` the distances are
    removed again.
    """
    check_percentile(percentile)
    spark = table.sparkSession
    path, version = detector_path(root, k, percentile) if root else None, new_version()
    if path and mode == "errorifexists" and exists(spark, f"{path}/versions"):
        raise FileExistsError(f"a detector already exists at {path}")
    scaler = fit_scaler(table)
    ready = standardize(table, scaler)
    if steps is None:
        clusters = fit_clusters(ready, k, seed=seed, max_iter=max_iter)
    else:
        clusters = Clusters(refine_centers(ready, first_centers(ready, k), steps))

    stored = f"{run_path(path, version)}/distances" if path else work_path(spark, "distances")
    distances = write_table(distances_table(assign(ready, clusters.centers)), stored)
    boundaries = cluster_boundaries(
        distances.selectExpr("predictions AS prediction", "distances AS distance"),
        percentile, boundary_method)
    detector = Detector(scaler, clusters.centers,
                        {r["prediction"]: r["boundary"] for r in boundaries.collect()})
    if not path:
        remove(spark, stored)
        return detector
    if clusters.model is not None:
        clusters.model.write().save(f"{run_path(path, version)}/model")
    detector.save(spark, path, mode, version)
    return detector
