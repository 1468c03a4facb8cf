"""Codec, wire format, configuration, control decisions, metrics, webhook rules."""

import datetime
import json
import threading
import urllib.request
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from flowtide import config, metrics
from flowtide.functions import codec
from flowtide.operators import control, encode, merge, snapshot
from flowtide.plans import changelog as log
from flowtide.schema import RAW_CHANGE, RELATION
from flowtide.sources import pgoutput as pg
from flowtide.streaming import sinks


def column(spark, values, kind, *expressions):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i long, v {kind}")
    return [tuple(r) for r in df.select(*expressions).orderBy("i").collect()]


# --- codec ---------------------------------------------------------------------------------------------------------


def test_quoting_round_trips(spark):
    alphabet = ["plain", 'a"b\\c', "\n\r\t", "".join(map(chr, range(32))), "\x85\u2028\u2029", "/<>\x7f", "日😀é", "", '\\"\n']
    got = column(spark, alphabet, "string", codec.json_quote(F.col("v")))
    for text, (j,) in zip(alphabet, got):
        assert json.loads(j) == text and not set(j) & {chr(c) for c in [*range(32), 0x85, 0x2028, 0x2029]}
    assert got[3][0].startswith('"\\u0000\\u0001') and "\\u0008" in got[3][0] and "\\u000c" in got[3][0]


@settings(max_examples=8, deadline=None)
@given(texts=st.lists(st.text(alphabet=st.characters(codec="utf-8"), max_size=30), min_size=20, max_size=60))
def test_quoting_of_any_text(spark, texts):
    for text, (j,) in zip(texts, column(spark, texts, "string", codec.json_quote(F.col("v")))):
        assert json.loads(j) == text and len(j.splitlines()) == 1


@pytest.mark.parametrize("oid,value,want", [
    (16, "t", "true"), (16, "f", "false"), (16, "x", "false"), (23, "-7", "-7"), (26, "4294967295", "4294967295"), (701, "1.5e+300", "1.5e+300"), (701, "NaN", '"NaN"'), (700, "-Infinity", '"-Infinity"'),
    (1700, "12.50", '"12.50"'), (3802, '{"k":[1, 2]}', '{"k":[1, 2]}'), (114, '{"a":\r\n1}', '{"a":1}'), (25, 'a"b', '"a\\"b"'), (1009, "{a,b}", '"{a,b}"'), (25, None, "null"),
])
def test_values(spark, oid, value, want):
    assert column(spark, [value], "string", codec.value_json(F.lit(oid), F.col("v"))) == [(want,)]


def test_invalid_utf8(spark):
    assert column(spark, [bytes.fromhex("61ff62c3")], "binary", codec.valid_utf8(F.col("v"))) == [("a�b�",)]


def test_widen_xid(spark):
    e = 1 << 32
    cases = [(5, 10, 5), (5, e - 1, e + 5), (e - 1, e + 5, e - 1), (e - 1, 5, e - 1), (7, 3 * e + 9, 3 * e + 7), (0, 0, 0)]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i long, xid long, ref long, want long")
    assert df.where(codec.widen_xid(F.col("xid"), F.col("ref")) != F.col("want")).count() == 0


def test_positions_and_times(spark):
    assert column(spark, [0x16B3748, (3 << 32) + 255], "long", codec.lsn_text(F.col("v"))) == [("0/16B3748",), ("3/FF",)]
    times = [datetime.datetime(2026, 9, 20, 10, 0, 0, us, datetime.UTC) for us in (0, 125000, 1, 100)]
    got = column(spark, times, "timestamp", codec.rfc3339(F.col("v")))
    assert [x for (x,) in got] == ["2026-09-20T10:00:00Z", "2026-09-20T10:00:00.125Z", "2026-09-20T10:00:00.000001Z", "2026-09-20T10:00:00.0001Z"]


@pytest.mark.parametrize("secret", [b"short", b"x" * 64, b"y" * 100])
def test_signature_is_hmac(spark, secret):
    body = '{"a":1}\n{"b":"é"}\n'
    ((got,),) = column(spark, [body], "string", codec.signature(secret, F.lit(1700000000), F.col("v")))
    assert got == sinks.sign(secret, 1700000000, body.encode())
    assert sinks.verify(secret, got, body.encode(), 1700000299) and not sinks.verify(secret, got, body.encode(), 1700000301) and not sinks.verify(secret, "x", b"", 0)


def test_topics_never_meet(spark):
    rows = [("a.b", "c"), ("a", "b.c"), ("a", "é"), ("a", "__"), ("a", "x" * 300), ("a", "x" * 301), ("", "a"), ("public", "orders"), ("a", "b\n")]
    df = spark.createDataFrame(rows, "s string, n string").select(codec.topic_name("p.", F.col("s"), F.col("n")).alias("t"))
    got = [r.t for r in df.collect()]
    assert len(set(got)) == len(rows) and got[7] == "p.public.orders" and got[2].startswith("p.a.__-") and all(len(t) <= 249 and t.isascii() for t in got)


# --- verdicts, decisions -------------------------------------------------------------------------------------------


def fold(ops):
    """One key's events by hand: (op, partial)."""
    complete = False
    for op, partial in ops:
        complete = not partial or (op == "update" and complete)
    return complete


def test_touches_by_brute_force(spark):
    import itertools

    rows, want, key = [], {}, 0
    for n in range(1, 5):
        for ops in itertools.product([("insert", True), ("insert", False), ("update", True), ("update", False), ("delete", False)], repeat=n):
            rows += [(str(key), 100 + i, i, op, 1000 - i, partial, "t") for i, (op, partial) in enumerate(ops)]
            want[str(key)] = (1000 - (n - 1), fold(ops))
            key += 1
    e = spark.createDataFrame(rows, "key_json string, commit_lsn long, seq long, op string, xid long, is_partial boolean, table string")
    assert {r.key_json: (r.xid, r.complete) for r in merge.fold_touches(e).collect()} == want


def test_chunk_merge_scenario(spark):
    touches = spark.createDataFrame([("t", "1", 900, True), ("t", "2", 911, False), ("t", "4", 899, True), ("u", "3", 999, True)], "table string, key_json string, xid long, complete boolean")
    chunk = spark.createDataFrame([(str(i), "t") for i in range(1, 5)], "key_json string, table string")
    none = spark.createDataFrame([], "table string, truncate_xid long")
    run = lambda t: {r.key_json: r.verdict for r in merge.judge_chunk(chunk, touches, t, 900).collect()}
    assert run(none) == {"1": "drop", "2": "retry", "3": "emit", "4": "emit"}
    assert set(run(spark.createDataFrame([("t", 900)], "table string, truncate_xid long")).values()) == {"drop"}
    assert run(spark.createDataFrame([("other", 900)], "table string, truncate_xid long"))["3"] == "emit"


def test_refusals(spark):
    good = dict(relkind="r", has_children=False, replica_identity="d", row_security=False, publishes_all=True, is_member=True, has_filters=False, n_keys=1, json_key=False)
    bad = dict(relkind="p", has_children=True, replica_identity="f", row_security=True, publishes_all=False, is_member=False, has_filters=True, n_keys=0, json_key=True)
    df = spark.createDataFrame([good, *({**good, k: v} for k, v in bad.items())])
    got = [r.x for r in df.select(snapshot.refusal(df).alias("x")).collect()]
    assert got[0] == "ok" and len(set(got)) == 1 + len(bad)


def test_qualified(spark):
    df = spark.createDataFrame([(["b", "s.a", "a"],)], "t array<string>")
    assert df.select(control.qualified(F.col("t"))).first()[0] == ["public.a", "public.b", "s.a"]


# --- wire format ---------------------------------------------------------------------------------------------------

USERS = pg.relation(42, "public", "users", [("id", 20, True), ("name", 25, False)])


def frames(spark, *messages):
    return spark.createDataFrame([(100 + i, bytearray(m)) for i, m in enumerate(messages)], "lsn long, frame binary").coalesce(1)


def test_decoded_and_encoded(spark):
    f = frames(
        spark, USERS, pg.begin(500, 7, pg.EPOCH_US + 1_500_000), pg.insert(42, ["1", 'ay"ma\n']), pg.update(42, ["1", ...]), pg.update(42, ["2", ...], ["1", None]), pg.delete(42, ["2", None]), pg.truncate([42]),
        pg.message(9, "{}"), pg.commit(500, 548), pg.begin(600, 8), pg.insert(42, ["3", "never committed"]),
    )
    e = encode.encode(pg.changes(f), pg.relations(f)).orderBy("commit_lsn", "seq").collect()
    assert [(r.op, r.origin, r.seq, r.key_json) for r in e] == [
        ("insert", None, 0, '{"id":1}'), ("update", None, 1, '{"id":1}'), ("delete", "update", 2, '{"id":1}'), ("insert", "update", 3, '{"id":2}'), ("delete", None, 4, '{"id":2}'), ("truncate", None, 5, '"public.users"'),
    ]
    assert e[0].value_json == '{"table":"public.users","op":"insert","lsn":"0/66","commit_lsn":"0/1F4","seq":0,"txid":7,"ts":"2000-01-01T00:00:01.5Z","new":{"id":1,"name":"ay\\"ma\\n"}}'
    assert json.loads(e[1].value_json)["unchanged"] == ["name"] and e[1].is_partial and "old" not in json.loads(e[1].value_json)
    assert json.loads(e[2].value_json)["old"] == {"id": 1} and json.loads(e[3].value_json)["new"] == {"id": 2}
    assert {r.end_lsn for r in e} == {548}


def test_key_taken_from_the_old_image_and_full_identity(spark):
    full = pg.relation(43, "public", "log", [("id", 20, True), ("v", 25, False)], identity="f")
    f = frames(spark, USERS, full, pg.begin(500, 7), pg.update(42, [..., "n"], ["9", None]), pg.update(43, ["1", "b"], ["1", "a"], "O"), pg.commit(500, 548))
    e = encode.encode(pg.changes(f), pg.relations(f)).orderBy("seq").collect()
    assert e[0].key_json == '{"id":9}' and e[0].op == "update" and e[0].unchanged == ["id"]
    assert e[1].key_json == '"public.log"' and json.loads(e[1].value_json)["old"] == {"id": 1, "v": "a"}


@pytest.mark.parametrize("message,error", [(pg.insert(77, ["1", "x"]), "unknown relation"), (pg.insert(42, ["1"]), "as many columns"), (pg.insert(42, [None, "x"]), "no value"), (pg.insert(42, [..., "x"]), "no value")])
def test_unencodable(spark, message, error):
    f = frames(spark, USERS, pg.begin(500, 7), message, pg.commit(500, 548))
    with pytest.raises(Exception, match=error):
        encode.encode(pg.changes(f), pg.relations(f)).collect()


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=60))
def test_decoder_on_any_bytes(raw):
    try:
        pg.decode(raw)
    except pg.Undecodable:
        pass


def test_demux():
    assert pg.demux(b"w" + bytes(7) + b"\5" + bytes(16) + b"body") == ("frame", {"lsn": 5, "end": 0, "frame": b"body"})
    assert pg.demux(b"k" + bytes(7) + b"\7" + bytes(8) + b"\1") == ("keepalive", {"end": 7, "reply": True}) and pg.demux(b"x") is None and pg.demux(b"") is None


def test_ignored_tables_take_no_number(spark):
    rows = log.relations(spark)
    own = encode.with_relation(log.state_log(spark.createDataFrame([(0, "O", 1.0, "p")], "o_orderkey long, o_orderstatus string, o_totalprice double, o_orderpriority string")), rows)
    assert own.count() == 1 and encode.ignore_tables(own, log.STATE_SCHEMA, log.STATE_TABLES).count() == 0 and encode.ignore_tables(own, "public", log.STATE_TABLES).count() == 1
    assert encode.encode(log.empty_log(spark), spark.createDataFrame([], RELATION)).count() == 0
    assert spark.createDataFrame([], RAW_CHANGE).columns[0] == "lsn"


# --- configuration -------------------------------------------------------------------------------------------------

BASE = {"DATABASE_URL": "postgres://x"}
HOOK = {"SINK": "webhook", "WEBHOOK_URL": "https://h/x", "WEBHOOK_SECRET": "s" * 16}
KAFKA = {"SINK": "kafka", "KAFKA_BROKERS": "b:9092", "KAFKA_TLS": "true"}


@pytest.mark.parametrize("extra", [
    {}, {"PUBLICATION_TABLES": "a, s.b"}, {"BACKFILL_TABLES": "all"}, {"BACKFILL_TABLES": "public.all"}, {"METRICS_ADDR": ":9090"}, {"BATCH_LINGER": "1m30s"}, HOOK, HOOK | {"WEBHOOK_URL": "http://127.0.0.1:8/x"}, HOOK | {"WEBHOOK_URL": "http://[::1]/"},
    KAFKA, {"SINK": "kafka", "KAFKA_BROKERS": "localhost:1,127.0.0.1:2"}, KAFKA | {"KAFKA_SASL_MECHANISM": "plain", "KAFKA_SASL_USERNAME": "u", "KAFKA_SASL_PASSWORD": "p"},
])
def test_accepted(extra):
    env = BASE | extra
    c = config.load(env, dotenv="/nonexistent")
    assert not set(env) & set(config.SECRETS) and "s" * 16 not in repr(c) and "postgres" not in repr(c)


@pytest.mark.parametrize("extra", [
    {"DATABASE_URL": ""}, {"SLOT_NAME": "Bad"}, {"SLOT_NAME": "a\n"}, {"PUBLICATION_NAME": "1x"}, {"PUBLICATION_TABLES": "a.b.c"}, {"STATE_SCHEMA": "public"}, {"STATE_SCHEMA": "pg_x"}, {"SLOT_RECREATE_GENERATION": "-1"}, {"BACKFILL_TABLES": "all,a"},
    {"BACKFILL_TABLES": "a", "BACKFILL_CHUNK_ROWS": "0"}, {"METRICS_ADDR": "nope"}, {"PPROF_ENABLED": "true"}, {"SHUTDOWN_TIMEOUT": "0s"}, {"SERVER_TIMEOUT": "5s"}, {"FEEDBACK_INTERVAL": "0s"}, {"BATCH_MAX_BYTES": "0"}, {"RECONNECT_MIN_DELAY": "1m"}, {"SINK": "file"},
    {"BATCH_LINGER": "5"}, HOOK | {"WEBHOOK_URL": "h/x"}, HOOK | {"WEBHOOK_URL": "http://h/x"}, HOOK | {"WEBHOOK_URL": "https://u:p@h/"}, HOOK | {"WEBHOOK_SECRET": "short"}, HOOK | {"WEBHOOK_RETRY_MIN": "1h"}, {"SINK": "kafka"}, KAFKA | {"KAFKA_TLS": "false"},
    KAFKA | {"KAFKA_BROKERS": "b"}, KAFKA | {"KAFKA_SASL_MECHANISM": "gssapi"}, KAFKA | {"KAFKA_SASL_MECHANISM": "plain"}, {"SINK": "kafka", "KAFKA_BROKERS": "localhost:1", "KAFKA_SASL_MECHANISM": "plain", "KAFKA_SASL_USERNAME": "u", "KAFKA_SASL_PASSWORD": "p"},
    KAFKA | {"KAFKA_MAX_MESSAGE_BYTES": "0"}, KAFKA | {"KAFKA_TOPIC_PREFIX": "a b"}, KAFKA | {"KAFKA_TOPIC_PREFIX": "a" * 125},
])
def test_refused(extra):
    with pytest.raises(config.Invalid):
        config.load(BASE | extra, dotenv="/nonexistent")


def test_dotenv(tmp_path):
    (tmp_path / ".env").write_text("# note\nDATABASE_URL='postgres://y'\nexport SLOT_NAME=other\n")
    assert config.load({"SLOT_NAME": "mine"}, str(tmp_path / ".env")).slot_name == "mine"


# --- metrics, webhook ----------------------------------------------------------------------------------------------


def test_metrics_text():
    r = metrics.Registry()
    r.delivered("insert", 3)
    r.observe("end_to_end_seconds", -1)
    r.gauge("inflight_batches", lambda: 2)
    server = metrics.serve(r)
    with urllib.request.urlopen(f"http://127.0.0.1:{server.server_port}/metrics") as f:
        text = f.read().decode()
    server.shutdown()
    assert 'flowtide_events_delivered_total{op="insert"} 3' in text and 'flowtide_events_delivered_total{op="read"} 0' in text
    assert 'flowtide_end_to_end_seconds_hist_bucket{le="0.001"} 1' in text and "flowtide_inflight_batches 2" in text


@pytest.mark.parametrize("value,want", [("5", 5), ("0", 0), ("-7", 0), ("99999", 3600), ("9" * 30, 0), ("", 0), (None, 0), ("later", 0), ("Sun, 20 Sep 2026 10:00:30 GMT", 30), ("Sun, 20 Sep 2026 09:00:00 GMT", 0)])
def test_retry_after(value, want):
    assert sinks.parse_retry_after(value, 1789898400.0) == want


def test_delay_bounds():
    for n in (0, 1, 5, 70, 10_000):
        top = min(30.0, 0.5 * 2.0 ** min(n, 62))
        assert all(top / 2 <= sinks.delay(n, 0.5, 30.0) <= top for _ in range(50))


def test_worst_error():
    a, b, c = ValueError("x"), sinks.Rejected("y"), sinks.Stuck("z")
    assert sinks.worst([a, b, c]) is b and sinks.worst([a]) is a and sinks.worst([]) is None


@pytest.fixture
def receiver():
    """Answers with the listed statuses in turn, then 200."""
    state = {"answers": [], "seen": []}

    class Handler(BaseHTTPRequestHandler):
        def do_POST(self):
            body = self.rfile.read(int(self.headers["Content-Length"]))
            state["seen"].append((dict(self.headers), body))
            status, extra = state["answers"].pop(0) if state["answers"] else (200, {})
            self.send_response(status)
            for k, v in extra.items():
                self.send_header(k, v)
            self.send_header("Content-Length", "0")
            self.end_headers()

        def log_message(self, *_):
            pass

    server = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    state["url"] = f"http://127.0.0.1:{server.server_port}/hook"
    yield state
    server.shutdown()


def test_webhook_retries_in_place(receiver):
    waits = []
    receiver["answers"] = [(500, {}), (429, {"Retry-After": "7"}), (408, {})]
    hook = sinks.Webhook(receiver["url"], b"s" * 32, sleep=waits.append)
    hook.send(b'{"a":1}\n', 1)
    heads = [h for h, _ in receiver["seen"]]
    assert [h["X-Attempt"] for h in heads] == ["1", "2", "3", "4"] and len({h["Idempotency-Key"] for h in heads}) == 1 and waits[1] == 7
    assert sinks.verify(b"s" * 32, heads[-1]["X-Signature"], b'{"a":1}\n', __import__("time").time())
    assert hook.registry.counters["sink_retries_total"] == 3
    hook.send(b"", 0)
    assert len(receiver["seen"]) == 4


@pytest.mark.parametrize("status", [400, 404, 301])
def test_webhook_rejections(receiver, status):
    receiver["answers"] = [(status, {"Location": receiver["url"]})]
    with pytest.raises(sinks.Rejected) as e:
        sinks.Webhook(receiver["url"], b"s" * 32).send(b"secret row\n", 1)
    assert "secret" not in str(e.value) and "127.0.0.1" not in str(e.value) and len(receiver["seen"]) == 1


def test_webhook_gives_up():
    with pytest.raises(sinks.Stuck):
        sinks.Webhook("http://127.0.0.1:9/", b"s" * 32, settle=-1, sleep=lambda _: None).send(b"x\n", 1)


def test_bodies():
    assert [(len(b), n) for b, n in sinks.bodies(["aaa", "bbb", "cc", "d"], 8)] == [(8, 2), (5, 2)]


def test_kafka_options():
    o = sinks.kafka_options(["a:1", "b:2"], True, "scram-sha-256", 'u"', "p\\")
    assert o["kafka.security.protocol"] == "SASL_SSL" and 'username="u\\""' in o["kafka.sasl.jaas.config"] and o["kafka.acks"] == "all"
