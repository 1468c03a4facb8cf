"""The text stream sink, and which broker errors are for good."""

import io

import pytest

from flowtide.streaming import sinks


def test_lines_in_order_one_batch_at_once(spark):
    d = spark.createDataFrame([(2, 1, 0, "c"), (1, 1, 1, "b"), (1, 0, 5, "a")], "pos_lsn long, is_stream int, seq long, value_json string").repartition(3)
    out = io.StringIO()
    w = sinks.StreamWriter(out)
    w.write(d, 0)
    w.write(d.limit(0), 1)
    assert out.getvalue() == "a\nb\nc\n"
    w.busy.acquire()
    with pytest.raises(sinks.Stuck):
        w.write(d, 2)


@pytest.mark.parametrize("text,final", [
    ("Job aborted: org.apache.kafka.common.errors.RecordTooLargeException: 5 bytes of 'secret'", True), ("org.apache.kafka.common.errors.TimeoutException: x", False),
    ("a org.apache.kafka.common.errors.NetworkException b org.apache.kafka.common.errors.TopicAuthorizationException", True), ("disk full", False),
])
def test_broker_errors(text, final):
    e = RuntimeError(text)
    told = sinks.kafka_error(e)
    assert isinstance(told, sinks.Rejected) == final and (told is e) == (not final) and "secret" not in (str(told) if final else "")
