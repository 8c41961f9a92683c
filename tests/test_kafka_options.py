import pytest

from cardpulse.sources import kafka


def test_source_options_defaults_and_extras():
    o = kafka.source_options("b:9092", "transactions")
    assert o == {"kafka.bootstrap.servers": "b:9092", "subscribe": "transactions",
                 "startingOffsets": "latest", "failOnDataLoss": "false"}
    o = kafka.source_options("b:9092", "t", group_id="g", max_offsets_per_trigger=100, min_partitions=12,
                             starting='{"t":{"0":5}}', ending="latest")
    assert o["kafka.group.id"] == "g" and o["maxOffsetsPerTrigger"] == "100"
    assert o["minPartitions"] == "12" and o["startingOffsets"] == '{"t":{"0":5}}'
    assert o["endingOffsets"] == "latest"


def test_source_requires_servers():
    with pytest.raises(ValueError):
        kafka.source_options("", "t")


def test_records_roundtrip(spark):
    from cardpulse.sources import decode as dec
    from cardpulse.sources.model import model_records
    from .conftest import SF001
    m = model_records(spark, SF001)
    recs = kafka.to_records(m)
    assert recs.columns == ["key", "value"]
    back = dec.decode(recs)
    assert back.count() == m.count()
    k = recs.first().key
    assert bytes(k).decode("utf-8").startswith("txn_")
