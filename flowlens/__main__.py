"""Command line of the jobs: ``python -m flowlens JOB --help``."""

import argparse
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from flowlens.operators.detector import Detector
from flowlens.plans.elbow import snapshot_and_sweep
from flowlens.plans.evaluation import score_labelled
from flowlens.plans.history import score_history
from flowlens.plans.learning import detector_path, train
from flowlens.sinks.documents import http_sender
from flowlens.sinks.tables import compact_day
from flowlens.sources.lines import file_lines, kafka_lines, kafka_options, netflow_events
from flowlens.sources.tables import read_features, read_labelled_csv, read_training_set
from flowlens.streaming.batches import INTERVAL
from flowlens.streaming.capture import capture_features, capture_rejected
from flowlens.streaming.scoring import score_stream, score_windows
from flowlens.streaming.windowed import capture_windows


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="flowlens")
    jobs = top.add_subparsers(dest="job", required=True)

    def job(name: str, text: str) -> argparse.ArgumentParser:
        return jobs.add_parser(name, help=text, description=text)

    def stream_arguments(p: argparse.ArgumentParser) -> None:
        source = p.add_mutually_exclusive_group(required=True)
        source.add_argument("--brokers", help="message brokers, with --topics")
        source.add_argument("--lines", help="folder of text files")
        p.add_argument("--topics", help="comma-separated topics")
        p.add_argument("--checkpoint", required=True)
        p.add_argument("--interval", default=INTERVAL)
        p.add_argument("--once", action="store_true", help="process what is there, then stop")
        how = p.add_mutually_exclusive_group(required=True)
        how.add_argument("--windows", action="store_true",
                         help="complete event-time windows, whatever the batches are")
        how.add_argument("--wall-clock", action="store_true",
                         help="each batch is one interval, labelled by the clock")
        p.add_argument("--bucket-seconds", type=int, default=300, help="length of a window")
        p.add_argument("--delay", default="10 minutes",
                       help="how late an event may be; later ones are dropped")
        p.add_argument("--state-partitions", type=int,
                       help="fixed by the first start; required on a cluster")
        p.add_argument("--starting-offsets", default="latest")
        p.add_argument("--max-offsets-per-trigger", type=int)
        p.add_argument("--max-files-per-trigger", type=int)
        p.add_argument("--strict", action="store_true",
                       help="check the sensor type of each parsed line")
        p.add_argument("--rejected", help="table for lines that cannot be read")

    def day_arguments(p: argparse.ArgumentParser) -> None:
        p.add_argument("--first-day", required=True)
        p.add_argument("--last-day", required=True)

    def model_arguments(p: argparse.ArgumentParser) -> None:
        p.add_argument("--root", required=True, help="folder of models")
        p.add_argument("-k", type=int, required=True, help="number of clusters")
        p.add_argument("--percentile", type=int, required=True)

    p = job("capture", "stream flow lines into the feature table")
    stream_arguments(p)
    p.add_argument("--features", required=True)

    p = job("elbow", "store a training set and the cost per number of clusters")
    p.add_argument("--features", required=True)
    day_arguments(p)
    p.add_argument("--root", required=True)
    p.add_argument("--first-k", type=int, default=2)
    p.add_argument("--last-k", type=int, default=60)
    p.add_argument("--scaled", action="store_true")
    p.add_argument("--each", action="store_true", help="one fit per number of clusters")
    p.add_argument("--parallelism", type=int, default=4, help="fits at a time, with --each")

    p = job("learn", "train a detector from a stored training set")
    p.add_argument("--training-set", required=True)
    model_arguments(p)
    p.add_argument("--overwrite", action="store_true")

    p = job("predict", "stream flow lines through a detector")
    stream_arguments(p)
    model_arguments(p)
    p.add_argument("--anomalies", required=True)
    p.add_argument("--post-to", help="address that takes the anomaly documents")
    p.add_argument("--refresh", action="store_true", help="reload the detector for each batch")

    p = job("history", "score stored days")
    p.add_argument("--features", required=True)
    day_arguments(p)
    model_arguments(p)
    p.add_argument("--anomalies", required=True)
    p.add_argument("--load-id", help="a re-run with the same id replaces its own rows")
    p.add_argument("--post-to")

    p = job("evaluate", "score a labelled CSV beside its labels")
    p.add_argument("--csv", required=True)
    model_arguments(p)
    p.add_argument("--out", required=True)
    p.add_argument("--drop-bad-rows", action="store_true",
                   help="leave unusable rows out instead of stopping")

    p = job("compact", "rewrite a closed day of a table as one load")
    p.add_argument("--table", required=True)
    p.add_argument("--day", required=True)
    p.add_argument("--keep-replaced", action="store_true", help="leave the old loads' files")
    return top


def stream_lines(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    if args.lines:
        return file_lines(spark, args.lines, True, args.max_files_per_trigger)
    return kafka_lines(spark, kafka_options(
        args.brokers, args.topics or "", args.starting_offsets, args.max_offsets_per_trigger))


def await_streams(*queries: StreamingQuery) -> None:
    """Wait until all have ended; a failure of any is raised."""
    while any(query.isActive for query in queries):
        for query in queries:
            query.awaitTermination(5)
    for query in queries:
        query.awaitTermination()


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"flowlens {args.job}").getOrCreate()

    def detector() -> str:
        return detector_path(args.root, args.k, args.percentile)

    def sender():
        return http_sender(args.post_to) if args.post_to else None

    def segment() -> str:
        return time.strftime("%H:%M:00")

    def stream_options() -> dict:
        return {"interval": args.interval, "available_now": args.once}

    def window_options() -> dict:
        return {"bucket_seconds": args.bucket_seconds, "delay": args.delay,
                "state_partitions": args.state_partitions} | stream_options()

    def rejected() -> list[StreamingQuery]:
        if not args.rejected:
            return []
        return [capture_rejected(stream_lines(spark, args), args.rejected,
                                 f"{args.checkpoint}-rejected", **stream_options())]

    if args.job == "capture" and args.windows:
        events = netflow_events(stream_lines(spark, args), args.strict)
        await_streams(capture_windows(events, args.features, args.checkpoint,
                                      **window_options()), *rejected())
    elif args.job == "capture":
        await_streams(capture_features(stream_lines(spark, args), args.features, args.checkpoint,
                                       segment, args.strict, **stream_options()), *rejected())
    elif args.job == "elbow":
        table = read_features(spark, args.features, args.first_day, args.last_day)
        snapshot_and_sweep(table, args.root, range(args.first_k, args.last_k + 1),
                           args.scaled, method="each" if args.each else "shared",
                           parallelism=args.parallelism)
    elif args.job == "learn":
        train(read_training_set(spark, args.training_set), args.k, args.percentile, args.root,
              mode="overwrite" if args.overwrite else "errorifexists")
    elif args.job == "predict":
        common = {"send": sender(), "refresh_each_batch": args.refresh}
        if args.windows:
            events = netflow_events(stream_lines(spark, args), args.strict)
            query = score_windows(events, detector(), args.anomalies, args.checkpoint,
                                  **common, **window_options())
        else:
            query = score_stream(stream_lines(spark, args), detector(), args.anomalies,
                                 args.checkpoint, segment, strict=args.strict,
                                 **common, **stream_options())
        await_streams(query, *rejected())
    elif args.job == "history":
        score_history(spark, args.features, Detector.load(spark, detector()), args.first_day,
                      args.last_day, args.anomalies, args.load_id, sender())
    elif args.job == "compact":
        compact_day(spark, args.table, args.day, args.keep_replaced)
    else:
        rows = read_labelled_csv(spark, args.csv, "drop" if args.drop_bad_rows else "fail")
        scored = score_labelled(rows, Detector.load(spark, detector()))
        scored.write.parquet(args.out)


if __name__ == "__main__":
    main()
