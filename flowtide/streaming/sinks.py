"""Deliveries: lines of text, signed webhooks, records routed to topics; and what makes them at-least-once.

Every sink takes one micro-batch at a time (foreachBatch) and returns only after all of it is delivered, so the checkpoint's
commit log is a contiguous acknowledgement. A failure raises, Spark replays the batch, and consumers drop what they have.
Errors name an event by its position, never by its data.
"""

from __future__ import annotations

import email.utils
import hashlib
import hmac
import http.client
import random
import re
import threading
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from typing import TextIO

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import codec
from ..metrics import Registry

MAX_RETRY_AFTER = 3600.0
HEADERS = {"Content-Type": "application/x-ndjson"}


class Rejected(Exception):
    """The receiver refused for good: a replay would fail the same way."""


class Stuck(Exception):
    """A delivery did not end in time."""


FATAL = (Rejected, Stuck)


def worst(errors: Iterable[Exception]) -> Exception | None:
    """Of several failures the first fatal one, else the first."""
    errors = list(errors)
    return next((e for e in errors if isinstance(e, FATAL)), errors[0] if errors else None)


# --- text ----------------------------------------------------------------------------------------------------------


def text_writer(path: str) -> Callable[[DataFrame, int], None]:
    """A folder a batch, named by its id: a replayed batch replaces its own. Partitions write alone; keys stay in order within a file."""

    def write(batch: DataFrame, batch_id: int) -> None:
        ordered = batch.repartition("key_json").sortWithinPartitions("pos_lsn", "is_stream", "seq")
        ordered.select("value_json").write.mode("overwrite").text(f"{path}/batch={batch_id:012d}")

    return write


class StreamWriter:
    """Lines to an open text stream, such as standard output, in total order, a partition at a time. One batch is written at once."""

    def __init__(self, out: TextIO):
        self.out, self.busy = out, threading.Lock()

    def write(self, batch: DataFrame, batch_id: int) -> None:
        if not self.busy.acquire(blocking=False):
            raise Stuck("another batch is still being written")
        try:
            wrote = False
            for r in batch.select("pos_lsn", "is_stream", "seq", "value_json").orderBy("pos_lsn", "is_stream", "seq").toLocalIterator():
                self.out.write(r.value_json + "\n")
                wrote = True
            if wrote:
                self.out.flush()
        finally:
            self.busy.release()


# --- webhook -------------------------------------------------------------------------------------------------------


def sign(secret: bytes, at: int, body: bytes) -> str:
    return f"t={at},v1={hmac.new(secret, f'{at}.'.encode() + body, hashlib.sha256).hexdigest()}"


def verify(secret: bytes, given: str, body: bytes, now: int, tolerance: int = 300) -> bool:
    at, _, mac = given.partition(",v1=")
    if not at.startswith("t=") or not at[2:].isdigit():
        return False
    return abs(now - int(at[2:])) <= tolerance and hmac.compare_digest(sign(secret, int(at[2:]), body), f"{at},v1={mac}")


def retryable(status: int) -> bool:
    return status >= 500 or status in (408, 429)


def parse_retry_after(value: str | None, now: float) -> float:
    """Seconds or an HTTP date, between 0 and an hour; 0 for anything else."""
    value = (value or "").strip()
    if value.lstrip("+-").isdigit():
        n = int(value)
        return 0.0 if abs(n) >= 1 << 63 else float(min(max(n, 0), MAX_RETRY_AFTER))
    try:
        at = email.utils.parsedate_to_datetime(value).timestamp()
    except (TypeError, ValueError):
        return 0.0
    return min(max(at - now, 0.0), MAX_RETRY_AFTER)


def delay(attempt: int, least: float, most: float) -> float:
    """Between half and all of an exponential delay, bounded."""
    d = min(most, least * 2.0 ** min(attempt, 62))
    return random.uniform(d / 2, d)


class _NoRedirect(urllib.request.HTTPRedirectHandler):
    def redirect_request(self, *_):
        return None


@dataclass
class Webhook:
    """Posts NDJSON bodies one at a time, in order, and retries in place."""

    url: str
    secret: bytes
    max_bytes: int = 65536
    timeout: float = 10.0
    retry_min: float = 0.5
    retry_max: float = 30.0
    settle: float = 300.0
    registry: Registry = field(default_factory=Registry)
    sleep: Callable[[float], None] = time.sleep

    def send(self, body: bytes, events: int) -> None:
        if not body:
            return
        key, began, attempt = hashlib.sha256(body).hexdigest()[:32], time.monotonic(), 0
        opener = urllib.request.build_opener(_NoRedirect)
        while True:
            now = int(time.time())
            request = urllib.request.Request(self.url, body, HEADERS | {"X-Signature": sign(self.secret, now, body), "Idempotency-Key": key, "X-Events": str(events), "X-Attempt": str(attempt + 1)}, method="POST")
            wait = 0.0
            try:
                with opener.open(request, timeout=self.timeout) as r:
                    r.read()
                self.registry.observe("sink_delivery_seconds", time.monotonic() - began)
                return
            except urllib.error.HTTPError as e:
                if not retryable(e.code):
                    raise Rejected(f"the receiver answered {e.code} to batch {key}") from None
                wait = parse_retry_after(e.headers.get("Retry-After"), time.time())
            except (urllib.error.URLError, OSError, http.client.HTTPException):
                pass  # its text may hold the URL
            attempt += 1
            self.registry.add("sink_retries_total")
            if time.monotonic() - began > self.settle:
                raise Stuck(f"batch {key} was not delivered in {self.settle:g} s")
            self.sleep(max(wait, delay(attempt - 1, self.retry_min, self.retry_max)))

    def write(self, batch: DataFrame, batch_id: int) -> None:
        """Rows in total order, a partition at a time, so the driver holds one partition and one body."""
        ordered = batch.select("pos_lsn", "is_stream", "seq", "op", "value_json").orderBy("pos_lsn", "is_stream", "seq")
        for body, events in bodies((r.value_json for r in ordered.toLocalIterator()), self.max_bytes):
            self.send(body, events)
            self.registry.add("batches_delivered_total")
            self.registry.add("bytes_delivered_total", len(body))


def bodies(values: Iterable[str], max_bytes: int) -> Iterator[tuple[bytes, int]]:
    """Lines packed into bodies; one is sealed once it has max_bytes or more."""
    parts, size = [], 0
    for v in values:
        parts.append(v.encode() + b"\n")
        size += len(parts[-1])
        if size >= max_bytes:
            yield b"".join(parts), len(parts)
            parts, size = [], 0
    if parts:
        yield b"".join(parts), len(parts)


# --- topics --------------------------------------------------------------------------------------------------------


def kafka_records(events: DataFrame, prefix: str, emit_truncate: bool = False) -> DataFrame:
    """events with topic, key and value added, as Spark's Kafka sink takes them; truncates are skipped unless wanted."""
    e = events if emit_truncate else events.where("op <> 'truncate'")
    return e.withColumn("topic", codec.topic_name(prefix, F.col("schema_name"), F.col("table_name"))).withColumn("key", F.col("key_json")).withColumn("value", F.col("value_json"))


def kafka_options(brokers: list[str], tls: bool = False, mechanism: str = "", username: str = "", password: str = "", max_message_bytes: int = 1_000_012) -> dict[str, str]:
    """Options of the Kafka writer: all in-sync replicas, idempotent, no lingering."""
    out = {"kafka.bootstrap.servers": ",".join(brokers), "kafka.acks": "all", "kafka.enable.idempotence": "true", "kafka.linger.ms": "0", "kafka.max.request.size": str(max_message_bytes)}
    out["kafka.security.protocol"] = ("SASL_" if mechanism else "") + ("SSL" if tls else "PLAINTEXT")
    if mechanism:
        kind = {"plain": "PLAIN", "scram-sha-256": "SCRAM-SHA-256", "scram-sha-512": "SCRAM-SHA-512"}[mechanism]
        module = "plain.PlainLoginModule" if kind == "PLAIN" else "scram.ScramLoginModule"
        quoted = [x.replace("\\", "\\\\").replace('"', '\\"') for x in (username, password)]
        out |= {"kafka.sasl.mechanism": kind, "kafka.sasl.jaas.config": f'org.apache.kafka.common.security.{module} required username="{quoted[0]}" password="{quoted[1]}";'}
    return out


#: The client library's errors that may pass (its RetriableException and what derives from it).
KAFKA_RETRIABLE = frozenset("""ConcurrentTransactionsException CoordinatorLoadInProgressException CoordinatorNotAvailableException CorruptRecordException DisconnectException
EligibleLeadersNotAvailableException FencedLeaderEpochException FetchSessionIdNotFoundException InvalidFetchSessionEpochException InvalidMetadataException KafkaStorageException
LeaderNotAvailableException ListenerNotFoundException NetworkException NotControllerException NotCoordinatorException NotEnoughReplicasAfterAppendException
NotEnoughReplicasException NotLeaderForPartitionException NotLeaderOrFollowerException OffsetNotAvailableException PreferredLeaderNotAvailableException
ReplicaNotAvailableException RetriableException ThrottlingQuotaExceededException TimeoutException UnknownLeaderEpochException UnknownTopicIdException
UnknownTopicOrPartitionException UnstableOffsetCommitException""".split())
_KAFKA_ERROR = re.compile(r"org\.apache\.kafka\.common\.errors\.(\w+)")


def kafka_error(error: Exception) -> Exception:
    """Rejected, naming the kinds alone, if a broker's error in it would come again on a replay; else the error itself."""
    final = sorted(set(_KAFKA_ERROR.findall(str(error))) - KAFKA_RETRIABLE)
    return Rejected(f"the brokers refused records: {', '.join(final)}") if final else error


def kafka_writer(prefix: str, options: dict[str, str], emit_truncate: bool = False) -> Callable[[DataFrame, int], None]:
    """Rows of a key go to one partition in order: they are sorted within the task that holds the key."""

    def write(batch: DataFrame, batch_id: int) -> None:
        r = kafka_records(batch, prefix, emit_truncate).repartition("topic", "key").sortWithinPartitions("pos_lsn", "is_stream", "seq")
        try:
            r.select("topic", "key", "value").write.format("kafka").options(**options).save()
        except Exception as e:
            if (told := kafka_error(e)) is e:
                raise
            raise told from None  # its text may hold data

    return write
