"""What executors share: intermediate tables in the common folder, and broadcast models."""

from __future__ import annotations

from pyspark import Broadcast, cloudpickle
from pyspark.sql import DataFrame, SparkSession

from shelfcast.session import fresh_path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write once, read back: cuts lineage and survives the loss of executors."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def share(spark: SparkSession, value: object) -> Broadcast[bytes]:
    """Broadcast a value together with its class; tasks read it with `pickle.loads`."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))
