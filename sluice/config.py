"""Pipeline configuration (U6): one frozen dataclass instead of per-connector
configurator objects, built from the string option maps connectors use.

Option keys follow the reference connectors; the misspelt prefetch key
``prefectCount`` is accepted next to ``prefetchCount`` (Q6).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

# JMS session acknowledge modes and MQTT QoS names.
JMS_AUTO_ACKNOWLEDGE = 1
JMS_CLIENT_ACKNOWLEDGE = 2
JMS_DUPS_OK_ACKNOWLEDGE = 3
MQTT_QOS = ("AT_MOST_ONCE", "AT_LEAST_ONCE", "EXACTLY_ONCE")
KESTREL_NO_ACK = 0


@dataclass(frozen=True)
class PipelineConfig:
    protocol: str
    ack_mode: str = "auto"              # kafka / amqp: 'manual' keeps messages pending
    jms_ack_mode: int = JMS_AUTO_ACKNOWLEDGE
    is_queue: bool = True               # jms: queue (default) or topic
    prefetch: int | None = None         # amqp prefetch count
    requeue_on_fail: bool = False       # amqp: requeue failed messages, else dead-letter
    qos: str = "AT_MOST_ONCE"           # mqtt
    kestrel_ack_mode: int = KESTREL_NO_ACK
    queue_size: int = 1024              # in-process bound -> micro-batch admission (S12)
    expiration_ms: int = 30_000         # kestrel put expiry
    stream: str | None = None           # named output stream (P6)
    extra: dict[str, str] = field(default_factory=dict)

    @staticmethod
    def from_options(protocol: str, options: dict[str, str]) -> "PipelineConfig":
        o = dict(options)
        prefetch = o.pop("prefetchCount", None) or o.pop("prefectCount", None)
        qos = o.pop("qos", "AT_MOST_ONCE").upper()
        if qos not in MQTT_QOS:
            raise ValueError(f"unknown QoS {qos!r}")

        def as_bool(key: str, default: bool) -> bool:
            v = o.pop(key, None)
            return default if v is None else v.strip().lower() == "true"

        return PipelineConfig(
            protocol=protocol,
            ack_mode=o.pop("ackMode", "auto") if protocol in ("kafka", "amqp") else "auto",
            jms_ack_mode=int(o.pop("ackMode", JMS_AUTO_ACKNOWLEDGE)) if protocol == "jms" else JMS_AUTO_ACKNOWLEDGE,
            is_queue=as_bool("isQueue", True),
            prefetch=int(prefetch) if prefetch is not None else None,
            requeue_on_fail=as_bool("reQueue", False),
            qos=qos,
            kestrel_ack_mode=int(o.pop("ackMode", KESTREL_NO_ACK)) if protocol == "kestrel" else KESTREL_NO_ACK,
            queue_size=int(o.pop("queueSize", 1024)),
            expiration_ms=int(o.pop("expirationTime", 30_000)),
            stream=o.pop("stream", None),
            extra=o,
        )

    def ack_required(self, delivery_mode: Column | None = None) -> Column:
        """P12 for this source as a Column (JMS also looks at each message's
        delivery mode)."""
        from sluice.operators.envelope import ack_required
        dm = delivery_mode if delivery_mode is not None else F.lit(1)
        return ack_required(F.lit(self.protocol), F.lit(self.ack_mode), F.lit(self.jms_ack_mode), dm,
                            F.lit(self.qos), F.lit(self.kestrel_ack_mode))

    def admission(self) -> dict[str, str]:
        """S12 as source options: the prefetch count (AMQP) or else the size of the in-process queue bounds what a
        micro-batch takes -- of a Kafka topic, or of each queue of a landed log (``sources.broker_log``)."""
        if self.protocol == "kafka":
            return {"maxOffsetsPerTrigger": str(self.queue_size)}
        bound = self.prefetch if self.protocol == "amqp" and self.prefetch else self.queue_size
        return {"prefetch": str(bound)}
