"""Choose the number of clusters."""

from collections.abc import Iterable

from pyspark.sql import DataFrame

from flowlens.operators.clustering import elbow_curve, elbow_curve_pinned
from flowlens.operators.scaling import fit_scaler, standardize
from flowlens.sinks.tables import write_small_table, write_table


def snapshot_and_sweep(table: DataFrame, root: str, ks: Iterable[int] = range(2, 61),
                       scaled: bool = False, steps: int | None = None,
                       mode: str = "errorifexists", **options) -> DataFrame:
    """Store the training set, its scaler and the (k, cost) points; return the points.

    With ``steps`` the centres start at the first rows in key order and take that many
    steps, which repeats exactly; else ``options`` go to ``elbow_curve``.
    """
    root = root.rstrip("/")
    snapshot = write_table(table, f"{root}/training_set", mode)
    scaler = fit_scaler(snapshot)
    write_small_table(scaler.to_table(table.sparkSession), f"{root}/training_scaler", mode)
    column = "normalizedFeatures" if scaled else "features"
    ready = standardize(snapshot, scaler)
    points = (elbow_curve(ready, ks, column, **options) if steps is None
              else elbow_curve_pinned(ready, ks, steps, column))
    write_small_table(points, f"{root}/elbow_points", mode)
    return points
