"""Scoring a stream of requests against the registry.

`score_stream` joins one registry for the life of the query. `score_batches` looks the
registry up for every micro-batch, so models that were retrained meanwhile are used from the
next batch on; a batch that is replayed replaces its own answers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shelfcast.functions.vectors import FEATURE_MAP
from shelfcast.plans.scoring import score_requests
from shelfcast.session import path_exists, subfolders

REQUEST_DDL = f"store_nbr int, family string, date date, request {FEATURE_MAP.simpleString()}"


def read_requests(spark: SparkSession, folder: str, files_per_trigger: int = 100) -> DataFrame:
    return (
        spark.readStream.schema(REQUEST_DDL)
        .option("maxFilesPerTrigger", files_per_trigger)
        .parquet(folder)
    )


def score_stream(
    requests: DataFrame, registry: DataFrame, out: str, state: str
) -> StreamingQuery:
    """Stream-static join, exactly once into parquet; drains what is there and stops.

    `state` is the folder of the stream's own progress: a later start with the same folder
    goes on after the last request that was answered.
    """
    return (
        score_requests(requests, registry)
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", state)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def registry_versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the registries that were written completely, in ascending order."""
    names = [n for n in subfolders(spark, root) if n.startswith("version-")]
    whole = [n for n in names if path_exists(spark, f"{root}/{n}/_SUCCESS")]
    return sorted(int(n.removeprefix("version-")) for n in whole)


def publish_registry(registry: DataFrame, root: str) -> int:
    """Write the registry as the next version; readers see it once it is complete."""
    spark = registry.sparkSession
    taken = [int(n.removeprefix("version-")) for n in subfolders(spark, root) if n.startswith("version-")]
    version = max(taken, default=0) + 1
    registry.write.parquet(f"{root}/version-{version}")
    return version


def current_registry(spark: SparkSession, root: str) -> tuple[int, DataFrame]:
    versions = registry_versions(spark, root)
    if not versions:
        raise ValueError(f"no registry below {root}")
    return versions[-1], spark.read.parquet(f"{root}/version-{versions[-1]}")


def answer_batch(batch: DataFrame, batch_id: int, root: str, out: str) -> None:
    """Answers of one micro-batch by the current registry, in a folder of the batch's own."""
    version, registry = current_registry(batch.sparkSession, root)
    scored = score_requests(batch, registry).withColumn("registry_version", F.lit(version))
    scored.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")


def score_batches(requests: DataFrame, root: str, out: str, state: str) -> StreamingQuery:
    """Answer what is there, each micro-batch by the registry that is current then, and stop.

    Answers lie in one folder per batch number, and `state` remembers the batches, so a batch
    that failed half-way and is run again leaves one set of answers.
    """
    return (
        requests.writeStream.foreachBatch(lambda batch, number: answer_batch(batch, number, root, out))
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .start()
    )
