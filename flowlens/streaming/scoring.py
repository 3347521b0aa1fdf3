"""Stream flow lines through a detector into the anomaly table."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from flowlens.operators.connections import connection_features
from flowlens.operators.detector import Detector
from flowlens.plans.history import store_anomalies
from flowlens.sinks.documents import Send
from flowlens.sources.lines import netflow_events
from flowlens.streaming.batches import start_batches
from flowlens.streaming.ledger import BatchLedger
from flowlens.streaming.windowed import start_windows, windowed_features


def batch_scorer(spark: SparkSession, detector: Detector | str, refresh_each_batch: bool,
                 anomalies_path: str, checkpoint: str,
                 send: Send | None) -> Callable[[DataFrame, str], None]:
    """Score the features of a batch and store its anomalies.

    The detector is loaded once or, from a path, for each batch. A stored detector is one
    commit, so a scaler never meets another model's centres even if a new version is saved
    meanwhile. The version that a batch met is entered in the stream's ledger before it is
    scored, and so are the documents that were sent: a batch that is replayed meets the
    same version, stores the same rows, and sends only what is missing, whatever was
    trained in between.
    """
    if refresh_each_batch and not isinstance(detector, str):
        raise ValueError("refresh_each_batch needs the detector's path")
    ledger = BatchLedger(spark, checkpoint)
    loaded = detector
    if isinstance(detector, str) and not refresh_each_batch:
        loaded = Detector.load(spark, detector)

    def score(features: DataFrame, load_id: str) -> None:
        ledger.forget_before(load_id)
        current = loaded
        if refresh_each_batch:
            version = ledger.version_of(load_id, lambda: Detector.newest(spark, detector))
            current = Detector.load(spark, detector, version)
        store_anomalies(current.anomalies(features), anomalies_path, load_id, send,
                        ledger.documents)

    return score


def score_stream(lines: DataFrame, detector: Detector | str, anomalies_path: str,
                 checkpoint: str, segment: Callable[[], str], send: Send | None = None,
                 refresh_each_batch: bool = False, strict: bool = False,
                 **options) -> StreamingQuery:
    """Score every micro-batch as one interval, labelled by ``segment``."""
    score = batch_scorer(lines.sparkSession, detector, refresh_each_batch, anomalies_path,
                         checkpoint, send)

    def handle(events: DataFrame, load_id: str) -> None:
        score(connection_features(events, segment=segment()), load_id)

    return start_batches(netflow_events(lines, strict), handle, checkpoint, **options)


def score_windows(events: DataFrame, detector: Detector | str, anomalies_path: str,
                  checkpoint: str, bucket_seconds: int = 300, delay: str = "10 minutes",
                  state_partitions: int | None = None, send: Send | None = None,
                  refresh_each_batch: bool = False, **options) -> StreamingQuery:
    """Score every event-time window once, when it is complete.

    One row per address pair and window, however the input was cut into micro-batches.
    """
    score = batch_scorer(events.sparkSession, detector, refresh_each_batch, anomalies_path,
                         checkpoint, send)
    return start_windows(windowed_features(events, bucket_seconds, delay), score, checkpoint,
                         state_partitions, **options)
