"""Session helpers shared by all operators."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def prepare(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from the folder the driver uses."""
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *paths])
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (spark.checkpoint.dir). Where it is unset: a temporary one on a single machine, an error on a cluster."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if sc.getCheckpointDir() is None:
        if not named and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="linkloom-"))
    return named or sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Write df to the shared folder and continue from those files (survives lost executors)."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def if_small(df: DataFrame, rows: int = 50_000, size: int = 16 << 20) -> DataFrame:
    """Marks df for broadcast if it is counted to be small in rows and in bytes (of its text form); else the join shuffles. df should be cheap to read, as after cut()."""
    seen = df.limit(rows + 1).agg(F.count("*").alias("n"), F.coalesce(F.sum(F.length(F.to_json(F.struct("*")))), F.lit(0)).alias("size")).first()
    return F.broadcast(df) if seen["n"] <= rows and seen["size"] <= size else df


def spread(df: DataFrame, key: str, per_core: int = 3) -> DataFrame:
    """df in enough parts to keep all cores busy with per-row Python work; large inputs have them already and are not moved."""
    least = per_core * df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(least, key) if df.rdd.getNumPartitions() < least else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
