from pyspark.sql import functions as F

from cardpulse.operators.anomaly import isolation_forest
from cardpulse.operators.inject import FAR, inject_fraud
from cardpulse.sources.model import model_records
from cardpulse.sources.tables import transactions

from .conftest import SF01


def test_injection_rate_types_and_determinism(spark):
    m = model_records(spark, SF01, keep_source=True)
    a = inject_fraud(m)
    stats = a.agg(F.avg(F.col("is_fraud").cast("double")), F.countDistinct("fraud_type")).first()
    assert 0.03 < stats[0] < 0.05
    assert stats[1] == 5
    b = inject_fraud(m.repartition(7))
    ka = {r.transaction_id: tuple(r) for r in a.select("transaction_id", "amount", "city", "fraud_type").collect()}
    kb = {r.transaction_id: tuple(r) for r in b.select("transaction_id", "amount", "city", "fraud_type").collect()}
    assert ka == kb


def test_geographic_rewrite_moves_far(spark):
    m = model_records(spark, SF01, keep_source=True)
    geo = inject_fraud(m).filter(F.col("fraud_type") == "geographic_anomaly").select("city").collect()
    assert geo and all(r.city in {c for cs in FAR.values() for c in cs} for r in geo)


def test_isolation_forest_ranks_planted_outliers(spark):
    txn = transactions(spark, SF01)
    s = isolation_forest(txn, n_trees=50).toPandas()
    top = {r[0] for r in txn.orderBy(F.col("amount").desc()).limit(20).select("transaction_id").collect()}
    assert s[s.transaction_id.isin(top)].anomaly_score.mean() > s.anomaly_score.median()
    s2 = isolation_forest(txn, n_trees=50).toPandas()
    assert (s.sort_values("transaction_id").anomaly_score.values
            == s2.sort_values("transaction_id").anomaly_score.values).all()
