"""The command-line jobs: publish derived messages, then stream them."""
from cardpulse import cli
from cardpulse.session import shared_path
from cardpulse.sources import replay

from .conftest import SF001


def test_publish_csv_count(spark):
    out = shared_path(spark, "cli-csv")
    cli.main(["publish", "--sf-dir", SF001, "--mode", "csv", "--out", out, "--count", "25", "--inject"])
    df = spark.read.option("header", True).csv(out)
    assert df.count() == 25
    assert {"transaction_id", "is_fraud", "fraud_type"} <= set(df.columns)


def test_stream_replay_to_parquet(spark):
    src = replay.replay_dir_for(spark, SF001)
    out = shared_path(spark, "cli-stream")
    cli.main(["stream", "--source", "replay", "--replay-dir", src, "--sink", "parquet", "--out", out,
              "--available-now"])
    feats = spark.read.parquet(f"{out}/features")
    bad = spark.read.parquet(f"{out}/quarantine")
    assert feats.count() > 0 and bad.count() > 0
    assert "impossible_travel" in feats.columns


def test_batch_job_tables(spark):
    from pyspark.sql import functions as F
    import __spark_entry__ as entry
    out = shared_path(spark, "cli-batch")
    cli.main(["batch", "--sf-dir", SF001, "--out", out, "--odd-hour-amount", "100", "--limit-ratio", "0.001", "--spend-multiple", "0.01"])
    enriched = spark.read.parquet(f"{out}/enriched_transactions")
    alerts = spark.read.parquet(f"{out}/fraud_alerts")
    stats = spark.read.parquet(f"{out}/processing_stats").first()
    assert enriched.count() == stats.total_txns
    assert alerts.count() == entry.queries()["alerts_union"](spark, SF001).count()
    assert "event_date" in enriched.columns and enriched.select(F.countDistinct("event_date")).first()[0] > 1
