"""The six jobs one after the other, as a user runs them."""

import pytest
from pyspark.sql import functions as F

from flowlens.__main__ import main
from flowlens.catalog.flows import flow_lines
from flowlens.catalog.queries import labelled_csv_parse
from flowlens.sources.tables import read_anomalies, read_features


def test_jobs(spark, sf_dir, tmp_path):
    lines, features, windows, root, anomalies, out, csv, rejected = (
        str(tmp_path / n) for n in
        ("lines", "features", "windows", "root", "anomalies", "out", "csv", "rejected"))
    flow_lines(spark, sf_dir).write.text(lines)

    main(["capture", "--lines", lines, "--checkpoint", str(tmp_path / "c1"), "--once",
          "--features", features, "--wall-clock", "--strict", "--rejected", rejected])
    main(["capture", "--lines", lines, "--checkpoint", str(tmp_path / "c2"), "--once",
          "--features", windows, "--windows", "--bucket-seconds", "3600", "--delay", "1 hour",
          "--state-partitions", "3", "--max-files-per-trigger", "100", "--strict",
          "--starting-offsets", "earliest", "--max-offsets-per-trigger", "1000"])
    stored, hours = read_features(spark, features), read_features(spark, windows)
    assert 0 < stored.count() and 0 < hours.count()
    assert all(r[0].endswith(":00:00") for r in hours.select("tsegm_inittime").distinct().collect())
    assert not (tmp_path / "rejected").exists()

    days = ["--first-day", "2024-01-01", "--last-day", "2024-01-31"]
    before = sorted(hours.collect())
    for name in ("s1", "s2"):
        main(["compact", "--table", windows, "--day", "2024-01-10"])
    assert len(list((tmp_path / "windows" / "day=2024-01-10").glob("load_id=*"))) == 1
    hours = read_features(spark, windows)
    assert sorted(hours.collect()) == before
    main(["elbow", "--features", windows, *days, "--root", root, "--last-k", "3"])
    assert spark.read.parquet(f"{root}/elbow_points").count() == 2

    model = ["--root", root, "-k", "3", "--percentile", "90"]
    main(["learn", "--training-set", f"{root}/training_set", *model])
    main(["predict", "--lines", lines, "--checkpoint", str(tmp_path / "c3"), "--once",
          "--windows", "--bucket-seconds", "3600", "--delay", "1 hour", *model, "--anomalies", anomalies])
    found = read_anomalies(spark, anomalies).count()
    assert 0.05 < found / hours.count() < 0.15
    main(["history", "--features", windows, *days, *model, "--anomalies", anomalies])
    assert read_anomalies(spark, anomalies).count() == 2 * found
    main(["predict", "--lines", lines, "--checkpoint", str(tmp_path / "c4"), "--once",
          "--wall-clock", "--refresh", *model, "--anomalies", anomalies])

    labelled_csv_parse(spark, sf_dir).coalesce(1).write.csv(csv, header=True)
    main(["evaluate", "--csv", csv, *model, "--out", out, "--drop-bad-rows"])
    scored = spark.read.parquet(out)
    assert scored.where(F.col("pred_anom")).count() > 0


def test_bad_arguments():
    with pytest.raises(SystemExit):
        main(["capture", "--checkpoint", "c", "--features", "f"])
    with pytest.raises(SystemExit):
        main(["capture", "--checkpoint", "c", "--features", "f", "--lines", "l"])
