"""Message sources with the Kafka record layout (SRC1, SRC2, SRC5).

Both return ``key, value (binary), topic, partition, offset, timestamp`` so
that the Bronze projection does not care where the records come from.
"""

from __future__ import annotations

from typing import Mapping, Optional

from pyspark.sql import DataFrame, SparkSession

from ..schema import WIRE_SCHEMA


def kafka_options(
    servers: str,
    topic: str,
    api_key: Optional[str] = None,
    api_secret: Optional[str] = None,
    max_offsets_per_trigger: Optional[int] = None,
    min_partitions: Optional[int] = None,
    extra: Optional[Mapping[str, str]] = None,
) -> dict:
    """SRC1 options: one topic from the earliest offset, lost offsets tolerated,
    SASL_SSL/PLAIN when credentials are given. SRC5: ``maxOffsetsPerTrigger``
    caps the records per micro-batch (rate limit).

    ``min_partitions``: Spark tasks per micro-batch. By default there is one
    task per topic partition (6 on the reference topic), which caps the
    ingest parallelism of a whole cluster at six cores; with more, Spark splits
    the offset range of each partition over several tasks."""
    opts = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
    }
    if api_key is not None:
        jaas = (
            "org.apache.kafka.common.security.plain.PlainLoginModule required "
            f'username="{api_key}" password="{api_secret}";'
        )
        opts.update(
            {
                "kafka.security.protocol": "SASL_SSL",
                "kafka.sasl.mechanism": "PLAIN",
                "kafka.sasl.jaas.config": jaas,
            }
        )
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(int(max_offsets_per_trigger))
    if min_partitions:
        opts["minPartitions"] = str(int(min_partitions))
    opts.update(extra or {})
    return opts


def kafka_source(spark: SparkSession, servers: str, topic: str, streaming: bool = True, **kw) -> DataFrame:
    """SRC1: Kafka topic as a (streaming) DataFrame. Needs the Kafka connector
    on the classpath; one Spark task per topic partition (more with
    ``minPartitions``)."""
    opts = kafka_options(servers, topic, **kw)
    reader = spark.readStream if streaming else spark.read
    if not streaming:
        opts.pop("maxOffsetsPerTrigger", None)
    return reader.format("kafka").options(**opts).load()


def wire_source(
    spark: SparkSession,
    path: str,
    streaming: bool = False,
    fmt: str = "parquet",
    max_files_per_trigger: Optional[int] = None,
) -> DataFrame:
    """SRC2: wire records replayed from files (no broker needed).

    With ``streaming=True`` this is a file stream source; SRC5's rate limit is
    ``maxFilesPerTrigger``. The schema is fixed, never inferred.
    """
    if streaming:
        r = spark.readStream.schema(WIRE_SCHEMA).format(fmt)
        if max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", str(int(max_files_per_trigger)))
        return r.load(path)
    return spark.read.schema(WIRE_SCHEMA).format(fmt).load(path)


def write_wire(df: DataFrame, path: str, fmt: str = "parquet", kafka: Optional[Mapping[str, str]] = None) -> None:
    """SNK6 write: to a Kafka topic when ``kafka`` options are given
    (``kafka.bootstrap.servers``, ``topic``), else to wire files."""
    if kafka:
        df.select("key", "value").write.format("kafka").options(**kafka).save()
    else:
        df.write.mode("errorifexists").format(fmt).save(path)
