"""Score stored history."""

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from flowlens.operators.detector import Detector, anomaly_documents
from flowlens.sinks.documents import Send, deliver, send_documents
from flowlens.sinks.tables import append_anomalies
from flowlens.sources.tables import read_features


def store_anomalies(anomalies: DataFrame, path: str, load_id: str | None = None,
                    send: Send | None = None, ledger: str | None = None) -> None:
    """Append anomalies and, with ``send``, pass their documents on.

    With a ``ledger`` and a load id, a run that is repeated sends only the documents that
    an earlier one did not.
    """
    if send is None:
        append_anomalies(anomalies, path, load_id)
        return
    anomalies = anomalies.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        append_anomalies(anomalies, path, load_id)
        if ledger is None or load_id is None:
            send_documents(anomaly_documents(anomalies), send)
        else:
            deliver(anomaly_documents(anomalies), send, ledger, load_id)
    finally:
        anomalies.unpersist()


def score_history(spark: SparkSession, features_path: str, detector: Detector,
                  first_day: str, last_day: str, anomalies_path: str,
                  load_id: str | None = None, send: Send | None = None,
                  ledger: str | None = None) -> None:
    """Find the anomalies of the days in [first_day, last_day] and store them."""
    table = read_features(spark, features_path, first_day, last_day)
    store_anomalies(detector.anomalies(table), anomalies_path, load_id, send, ledger)
