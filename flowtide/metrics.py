"""Delivery metrics: counters and histograms as aggregates, and their text exposition."""

from __future__ import annotations

import threading
from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .schema import OPS

# Bucket bounds in seconds, and the quantiles shown.
BUCKETS = ("0.001", "0.005", "0.010", "0.025", "0.050", "0.100", "0.250", "0.500", "1.000", "2.500", "5.000", "10.000", "30.000", "60.000", "300.000")
QUANTILES = (0.5, 0.9, 0.99)
PREFIX = "flowtide"


def delivery_counters(events: DataFrame) -> DataFrame:
    """op, delivered, skipped, bytes: a row for every operation, even at zero; skipped events count neither as delivered nor in bytes."""
    spark = events.sparkSession
    ops = spark.createDataFrame([(o,) for o in OPS], "op string")
    size = F.octet_length("value_json") + 1 if "value_json" in events.columns else F.lit(0)
    n = events.groupBy("op").agg(
        F.count(F.when(~F.col("is_skipped"), 1)).alias("delivered"), F.count(F.when(F.col("is_skipped"), 1)).alias("skipped"), F.coalesce(F.sum(F.when(~F.col("is_skipped"), size)), F.lit(0)).alias("bytes")
    )
    return ops.join(n, "op", "left").na.fill(0, ["delivered", "skipped", "bytes"])


def histogram(rows: DataFrame, seconds: Column) -> DataFrame:
    """le, n: cumulative counts; negative latencies count as zero. One pass, one row of sums."""
    s = F.greatest(seconds, F.lit(0.0))
    sums = rows.agg(*(F.count(F.when(s <= float(b), 1)).alias(b) for b in BUCKETS))
    return sums.select(F.inline(F.array(*(F.struct(F.lit(b).alias("le"), F.col(f"`{b}`").alias("n")) for b in BUCKETS))))


def quantiles(rows: DataFrame, seconds: Column) -> DataFrame:
    return rows.agg(F.percentile_approx(F.greatest(seconds, F.lit(0.0)), list(QUANTILES)).alias("q"))


class Registry:
    """Counters, gauges and latencies of a running stream, rendered as Prometheus text; every series exists from the start."""

    def __init__(self, prefix: str = PREFIX):
        self.prefix, self._lock = prefix, threading.Lock()
        self.counters: dict[str, float] = defaultdict(float)
        self.gauges: dict[str, object] = {}
        self.latencies: dict[str, list[float]] = {"sink_delivery_seconds": [0.0] * (len(BUCKETS) + 2), "end_to_end_seconds": [0.0] * (len(BUCKETS) + 2)}
        for op in OPS:
            self.counters[f'events_delivered_total{{op="{op}"}}'] = 0
        for name in ("events_skipped", "batches_delivered", "bytes_delivered", "delivery_failures", "reconnects", "sink_retries", "backfill_rows", "backfill_chunks", "backfill_rows_superseded", "backfill_rows_reread"):
            self.counters[f"{name}_total"] = 0

    def add(self, name: str, n: float = 1) -> None:
        with self._lock:
            self.counters[name] += n

    def delivered(self, op: str, n: int) -> None:
        self.add(f'events_delivered_total{{op="{op}"}}', n)

    def gauge(self, name: str, read) -> None:
        self.gauges[name] = read

    def observe(self, name: str, seconds: float) -> None:
        seconds = max(0.0, seconds)
        with self._lock:
            h = self.latencies[name]
            for i, b in enumerate(BUCKETS):
                h[i] += seconds <= float(b)
            h[-2] += 1
            h[-1] += seconds

    def render(self) -> str:
        with self._lock:
            lines = [f"{self.prefix}_{k} {v:g}" for k, v in sorted(self.counters.items())]
            for name, h in self.latencies.items():
                lines += [f'{self.prefix}_{name}_hist_bucket{{le="{float(b):g}"}} {n:g}' for b, n in zip(BUCKETS, h)]
                lines += [f'{self.prefix}_{name}_hist_bucket{{le="+Inf"}} {h[-2]:g}', f"{self.prefix}_{name}_hist_count {h[-2]:g}", f"{self.prefix}_{name}_hist_sum {h[-1]:g}"]
        return "\n".join([*lines, *(f"{self.prefix}_{k} {float(v()):g}" for k, v in sorted(self.gauges.items()))]) + "\n"


def serve(registry: Registry, host: str = "127.0.0.1", port: int = 0):
    """GET /metrics on a daemon thread; returns the server, whose shutdown() ends it."""
    from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):
            body = registry.render().encode() if self.path == "/metrics" else b""
            self.send_response(200 if body else 404)
            self.send_header("Content-Type", "text/plain; version=0.0.4")
            self.send_header("Content-Length", str(len(body)))
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *_):
            pass

    server = ThreadingHTTPServer((host, port), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    return server
