"""Isolation forest (Liu, Ting & Zhou, 2008) trained and scored on Spark.

MLlib has no isolation forest, so:

1. *Sample.*  Each normal (unlabelled-as-fraud) row joins tree ``t`` when a
   pseudo-uniform of ``(id, t)`` falls below ``p = min(1, 2ψ/N)``; each tree
   group therefore holds about ``2ψ`` rows whatever the table size, and the
   ``ψ`` rows with the smallest draw are kept (a sampling operator).
2. *Build.*  ``groupBy(tree_id).applyInPandas`` grows one random tree per
   group (numpy, seeded by the tree id) to depth ``ceil(log2 ψ)``.
3. *Score.*  The forest has at most ``T·(2ψ−1)`` nodes — a bound that does
   not depend on the data — so it is collected and broadcast; every row is
   scored by ``mapInPandas`` with vectorised traversal (one numpy pass per
   tree level), giving ``s = 2^(−E[h(x)] / c(ψ))``.

Features: amount, 24 h transaction count of the card (frequency), local
time of day in hours, and the category's index.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship_package
from .features import card_features
from .rules import ALERT_COLUMNS

FEATURES = ("f_amount", "f_freq", "f_hour", "f_category")
CATEGORY_INDEX = {"purchase": 0, "view": 1, "click": 2, "signup": 3, "error": 4}
TREE_SCHEMA = ("tree_id int, node int, feature int, threshold double, left_child int, right_child int, "
               "leaf_size long, depth int")
EULER = 0.5772156649015329


def c_factor(n: float) -> float:
    """Average path length of an unsuccessful BST search over n points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1) + EULER) - 2.0 * (n - 1) / n


def feature_frame(txn: DataFrame, *keep: str) -> DataFrame:
    """The forest's features, with the columns ``keep`` passed along."""
    f = card_features(txn, windows=["24hr"], averages=[], baseline=False, previous=False, first_use=[])
    cat = F.create_map(*[x for k, v in CATEGORY_INDEX.items() for x in (F.lit(k), F.lit(float(v)))])
    return f.select(
        "transaction_id", "card_id", "is_fraud", *keep,
        F.col("amount").cast("double").alias("f_amount"),
        F.col("transactions_last_24hr").cast("double").alias("f_freq"),
        (F.hour("ts") + F.minute("ts") / 60.0).alias("f_hour"),
        F.coalesce(cat[F.col("merchant_category")], F.lit(-1.0)).alias("f_category"))


def _grow(tree_id: int, x: np.ndarray, max_depth: int, seed: int) -> list[tuple]:
    rng = np.random.default_rng(seed * 1_000_003 + tree_id)
    nodes: list[list] = []

    def build(idx: np.ndarray, depth: int) -> int:
        me = len(nodes)
        nodes.append([tree_id, me, -1, 0.0, -1, -1, int(len(idx)), depth])
        if depth >= max_depth or len(idx) <= 1:
            return me
        sub = x[idx]
        spread = sub.max(axis=0) - sub.min(axis=0)
        usable = np.flatnonzero(spread > 0)
        if usable.size == 0:
            return me
        f = int(rng.choice(usable))
        lo, hi = sub[:, f].min(), sub[:, f].max()
        thr = float(rng.uniform(lo, hi))
        go_left = sub[:, f] < thr
        left = build(idx[go_left], depth + 1)
        right = build(idx[~go_left], depth + 1)
        nodes[me][2:6] = [f, thr, left, right]
        return me

    build(np.arange(len(x)), 0)
    return [tuple(n) for n in nodes]


def member_draw(id_col: str, tree, seed: int):
    """Uniform of a (row, tree) pair from 53 bits of a 64-bit hash, so shares far
    below one in a million are met and trees draw independently."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), tree, F.col(id_col)), 11).cast("double") / F.lit(float(1 << 53))


def train(txn: DataFrame, n_trees: int = 100, psi: int = 256, seed: int = 7,
          features: DataFrame | None = None) -> DataFrame:
    """Forest as a node table (``TREE_SCHEMA``), trained on normal rows."""
    ship_package(txn.sparkSession)
    feats = (features if features is not None else feature_frame(txn)).filter(~F.col("is_fraud"))
    n = feats.count()
    p = min(1.0, 2.0 * psi / max(n, 1))
    depth = int(math.ceil(math.log2(psi)))
    draw = lambda t: member_draw("transaction_id", t, seed)
    trees = F.filter(F.sequence(F.lit(0), F.lit(n_trees - 1)), lambda t: draw(t) < F.lit(p))
    member = (feats.select(*FEATURES, "transaction_id", F.explode(trees).alias("tree_id"))
              .withColumn("u", draw(F.col("tree_id"))))

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["u", "transaction_id"]).head(psi)
        tid = int(pdf["tree_id"].iloc[0])
        rows = _grow(tid, pdf[list(FEATURES)].to_numpy(dtype=float), depth, seed)
        return pd.DataFrame(rows, columns=[c.split()[0] for c in TREE_SCHEMA.split(", ")])

    return member.groupBy("tree_id").applyInPandas(grow, TREE_SCHEMA)


def score(txn: DataFrame, forest_pdf: pd.DataFrame, psi: int = 256, threshold: float = 0.6,
          features: DataFrame | None = None) -> DataFrame:
    """Anomaly score per transaction with a broadcast (bounded) forest; batch or stream.

    Columns of ``features`` beside the forest's own stay in the result.
    """
    spark = txn.sparkSession
    ship_package(spark)
    trees = []
    for _, g in forest_pdf.groupby("tree_id"):
        g = g.sort_values("node")
        leaf = g["feature"].to_numpy() < 0
        adj = np.where(leaf, g["depth"].to_numpy() + np.array([c_factor(s) for s in g["leaf_size"]]), 0.0)
        trees.append((g["feature"].to_numpy(np.int64), g["threshold"].to_numpy(float),
                      g["left_child"].to_numpy(np.int64), g["right_child"].to_numpy(np.int64), adj))
    bc = spark.sparkContext.broadcast(trees)
    norm = c_factor(psi)
    max_depth = int(math.ceil(math.log2(psi)))
    feats = features if features is not None else feature_frame(txn)
    passed = [(n, t) for n, t in feats.dtypes if n not in FEATURES]

    def run(batches):
        forest = bc.value
        for pdf in batches:
            x = pdf[list(FEATURES)].to_numpy(dtype=float)
            total = np.zeros(len(pdf))
            for feat, thr, left, right, adj in forest:
                node = np.zeros(len(pdf), dtype=np.int64)
                for _ in range(max_depth + 1):
                    f = feat[node]
                    inner = f >= 0
                    if not inner.any():
                        break
                    val = x[np.arange(len(pdf)), np.where(inner, f, 0)]
                    nxt = np.where(val < thr[node], left[node], right[node])
                    node = np.where(inner, nxt, node)
                total += adj[node]
            s = np.power(2.0, -(total / len(forest)) / norm)
            yield pdf[[n for n, _ in passed]].assign(anomaly_score=s, is_outlier=s > threshold)

    return feats.mapInPandas(run, ", ".join(f"{n} {t}" for n, t in passed) + ", anomaly_score double, is_outlier boolean")


#: A stored forest of more nodes than this is refused: it is sent to every executor.
MAX_NODES = 2_000_000


def store_forest(forest: DataFrame, path: str, version: int, psi: int = 256, threshold: float = 0.6) -> None:
    """Write a trained node table as ``version`` of the model at ``path``; the same version is replaced, others stay."""
    (forest.withColumn("psi", F.lit(psi)).withColumn("outlier_over", F.lit(threshold))
     .coalesce(1).write.mode("overwrite").parquet(f"{path}/version={version}"))


def forest_versions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("basePath", path).parquet(f"{path}/version=*").groupBy("version").agg(
        F.count_distinct("tree_id").alias("trees"), F.count(F.lit(1)).alias("nodes"), F.max("psi").alias("psi"), F.max("outlier_over").alias("outlier_over"))


def score_stored(features: DataFrame, path: str, version: int | None = None) -> DataFrame:
    """Scores of ``features`` (batch or stream) by a stored forest, the newest unless ``version`` names one."""
    spark = features.sparkSession
    known = forest_versions(spark, path)
    found = (known.filter(F.col("version") == version) if version is not None else known.orderBy(F.col("version").desc())).first()
    if found is None:
        raise ValueError(f"no version {version} of the forest at {path}")
    if found["nodes"] > MAX_NODES:
        raise ValueError(f"{found['nodes']} nodes are too many to send to every executor (limit {MAX_NODES})")
    nodes = spark.read.parquet(f"{path}/version={found['version']}").toPandas()
    return score(features, nodes, found["psi"], found["outlier_over"], features=features)


def forest_alerts(txn: DataFrame, path: str, version: int | None = None) -> DataFrame:  # D6 U1
    """The rows that a stored forest finds unusual, in the shape of the alert table."""
    scored = score_stored(feature_frame(txn, "ts", "amount"), path, version)
    return scored.filter("is_outlier").select(*ALERT_COLUMNS, F.lit("isolation_forest").alias("rule"))


def isolation_forest(txn: DataFrame, n_trees: int = 100, psi: int = 256, seed: int = 7,
                     threshold: float = 0.6) -> DataFrame:
    """Train on normal rows and score every row.

    The feature table is written once to the shared checkpoint folder and
    read by both passes, so the per-card feature shuffle runs once and the
    scoring lineage starts at that table.
    """
    from ..session import shared_path
    spark = txn.sparkSession
    path = shared_path(spark, "iforest-features")
    feature_frame(txn).write.mode("overwrite").parquet(path)
    feats = spark.read.parquet(path)
    forest = train(txn, n_trees, psi, seed, features=feats).toPandas()  # ≤ n_trees·(2ψ−1) rows
    return score(txn, forest, psi, threshold, features=feats)
