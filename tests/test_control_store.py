import io
import json

import pytest

from flowtide import log
from flowtide.control_store import DONE, ControlStore, Progress, SlotUnusable, StateError, bootstrap, check_slot, check_source, create_slot, decide, ensure_publication, require_slot, tables_to_copy


@pytest.fixture
def store(spark, tmp_path):
    return ControlStore(spark, str(tmp_path))


@pytest.mark.parametrize("exists,generation,requested,action", [
    (True, 0, 0, "keep"), (True, 2, 3, "keep"), (True, None, 0, "adopt"), (True, None, 1, "adopt"), (False, None, 0, "create"), (False, None, 5, "create"),
    (False, 0, 1, "recreate"), (False, 2, 3, "recreate"), (False, 0, 0, "refuse"), (False, 0, 2, "refuse"), (False, 2, 2, "refuse"),
])
def test_decisions(exists, generation, requested, action):
    assert decide(exists, generation, requested) == action


def test_generations_have_one_taker(store):
    assert store.generation("s") is None
    store.record("s")
    store.record("s")
    store.spend("s", 1)
    assert store.generation("s") == 1
    for n in (1, 3, 0):
        with pytest.raises(StateError):
            store.spend("s", n)


def test_bootstrap(store):
    made = []
    assert bootstrap(store, "s", False, 0, lambda: made.append(store.generation("s"))) == "create" and made == [None]
    with pytest.raises(SlotUnusable):
        bootstrap(store, "s", False, 0, lambda: made.append("no"))
    assert bootstrap(store, "s", False, 1, lambda: made.append(store.generation("s"))) == "recreate" and made == [None, 1]
    assert bootstrap(store, "s", True, 2, lambda: made.append("no")) == "keep" and store.generation("s") == 2
    assert bootstrap(store, "other", True, 0, lambda: made.append("no")) == "adopt" and store.generation("other") == 0 and len(made) == 2


def test_backfill_progress(store):
    store.park("s", "public.t", [["1"]])
    assert store.progress("s", "public.t") is None
    assert store.register("s", "public.t", 7, 0) == Progress(7, 0)
    store.save_upper("s", "public.t", ["20"])
    store.save("s", "public.t", ["10"], 10)
    store.park("s", "public.t", [["5"], ["9007199254740993"]])
    p = store.register("s", "public.t", 7, 0)
    assert (p.upper, p.last, p.pending, p.rows) == (["20"], ["10"], [["5"], ["9007199254740993"]], 10)
    store.clear_pending("s", "public.t")
    store.finish("s", "public.t")
    store.park("s", "public.t", [["5"]])
    assert store.progress("s", "public.t").status == DONE and store.progress("s", "public.t").pending == []
    assert store.register("s", "public.t", 8, 0) == Progress(8, 0) and store.register("s", "public.t", 8, 1) == Progress(8, 1)
    assert store.register("s2", "public.t", 8, 1) == Progress(8, 1)


def test_table_lists():
    assert tables_to_copy(("a", "s.b"), [], "own") == ["public.a", "s.b"]
    assert tables_to_copy(("all",), ["public.b", "own.slots", "public.a"], "own") == ["public.a", "public.b"]
    with pytest.raises(StateError):
        tables_to_copy(("all",), ["public.a.b"], "own")


def test_log_lines():
    out = io.StringIO()
    log.make("warn", "json", out).warning("so %d", 3, extra={"fields": {"slot": "s"}})
    assert json.loads(out.getvalue())["message"] == "so 3" and json.loads(out.getvalue())["slot"] == "s"
    with pytest.raises(ValueError):
        log.make("loud")


def test_slots_that_can_serve(store):
    assert check_slot("s", "pgoutput", "reserved") and not check_slot("s", None, None)
    for plugin, status in (("test_decoding", "reserved"), ("pgoutput", "lost")):
        with pytest.raises(SlotUnusable):
            check_slot("s", plugin, status)
    assert create_slot("s", lambda name: 640, store) == 640 and store.generation("s") == 0
    require_slot(store, "s", 0, True)
    with pytest.raises(SlotUnusable):
        require_slot(store, "s", 0, False)
    assert create_slot("s", lambda name: 900, store, 1) == 900
    with pytest.raises(StateError):
        require_slot(store, "s", 0, True)


def test_publications_are_made_and_never_altered():
    made = []
    assert ensure_publication(None, ["t", "x.u"], made.append) == "created" and made == [["public.t", "x.u"]]
    cases = [((True, []), [], "kept"), ((True, []), ["t"], "drifted"), ((False, ["public.t"]), ["t"], "kept"), ((False, ["public.t"]), [], "drifted"), ((False, []), [], "drifted"), ((False, ["x.t"]), ["t"], "drifted")]
    for there, wanted, says in cases:
        assert ensure_publication(there, wanted, made.append) == says
    assert len(made) == 1


def test_sources_are_the_one_that_streams():
    assert check_source(False, "71", None) == check_source(False, "71", "71") == "71"
    for standby, system in ((True, "71"), (False, "72")):
        with pytest.raises(StateError):
            check_source(standby, system, "71")
