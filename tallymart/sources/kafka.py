"""Kafka options and row encodings. The connector package itself comes with the cluster."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..schemas import BATCH_INTERVAL


@dataclass(frozen=True)
class KafkaAccess:
    """SASL_SSL access with SCRAM-SHA-512."""

    host: str
    port: int
    user: str
    password: str = field(repr=False)
    topic: str
    cert_path: str
    group: str | None = None

    def client_options(self) -> dict[str, str]:
        user, password = (text.replace("\\", "\\\\").replace('"', '\\"')
                          for text in (self.user, self.password))
        return {
            "kafka.bootstrap.servers": f"{self.host}:{self.port}",
            "kafka.security.protocol": "SASL_SSL",
            "kafka.sasl.mechanism": "SCRAM-SHA-512",
            "kafka.sasl.jaas.config":
                "org.apache.kafka.common.security.scram.ScramLoginModule required "
                f'username="{user}" password="{password}";',
            "kafka.ssl.truststore.type": "PEM",
            "kafka.ssl.truststore.location": self.cert_path,
        }

    def source_options(self, max_offsets: int | None = None) -> dict[str, str]:
        """Start at the earliest offset; afterwards the stream's checkpoint holds the position."""
        options = {**self.client_options(), "subscribe": self.topic, "startingOffsets": "earliest"}
        if self.group:
            options["kafka.group.id"] = self.group
        if max_offsets:
            options["maxOffsetsPerTrigger"] = str(max_offsets)
        return options

    def sink_options(self) -> dict[str, str]:
        return {**self.client_options(), "topic": self.topic}


#: Messages of a batch at most: a topic read from its start comes in batches of this size.
MAX_OFFSETS = 1_000_000


def kafka_messages(spark: SparkSession, access: KafkaAccess,
                   max_offsets: int | None = MAX_OFFSETS) -> DataFrame:
    """The topic as a stream of (value, topic, partition, offset), bounded unless ``max_offsets`` is None."""
    return (spark.readStream.format("kafka").options(**access.source_options(max_offsets)).load()
            .select("value", "topic", "partition", "offset"))


def kafka_sink_encode(df: DataFrame) -> DataFrame:
    """Each row as one JSON object in ``value``, nulls written out."""
    return df.select(
        F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value"))


def start_sink(rows: DataFrame, checkpoint: str, sink: str, options: dict[str, str], once: bool = False,
               interval: str = BATCH_INTERVAL) -> StreamingQuery:
    """A stream of rows, encoded, into a sink: ``kafka`` with ``KafkaAccess.sink_options()``, or files.

    The checkpoint remembers what was sent: a restart sends on from there. To a topic a batch that broke off
    may be sent again; the file sink has each batch once.
    """
    trigger = {"availableNow": True} if once else {"processingTime": interval}
    return (kafka_sink_encode(rows).writeStream.format(sink).options(**options)
            .option("checkpointLocation", checkpoint).trigger(**trigger).start())


def kafka_write(df: DataFrame, access: KafkaAccess) -> None:
    kafka_sink_encode(df).write.format("kafka").options(**access.sink_options()).save()
