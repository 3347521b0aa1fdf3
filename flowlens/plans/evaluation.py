"""Score labelled rows beside their true labels."""

from pyspark.sql import DataFrame

from flowlens.operators.detector import Detector
from flowlens.schemas import LABELLED_RESULT


def score_labelled(labelled: DataFrame, detector: Detector) -> DataFrame:
    """Keys, vectors, cluster, distance, boundary, ``pred_anom`` and the truth columns."""
    return (detector.flags(labelled)
            .withColumnsRenamed({"prediction": "predictions", "distance": "distances"})
            .select(*LABELLED_RESULT))
