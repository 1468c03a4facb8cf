"""Control state on a shared file system: what slots were seen, their generations, and how far backfills are.

Every change is a new file created without overwriting, so of several writers one wins and the others learn that they lost; the
current state is what the files say together. Files are reached through Hadoop's file systems.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import SparkSession

RUNNING, DONE = "running", "done"


class StateError(RuntimeError):
    """Control state that can't be trusted or was taken by another."""


class SlotUnusable(RuntimeError):
    """Changes were lost and nobody has agreed to go on without them."""


class _Files:
    def __init__(self, spark: SparkSession, root: str):
        jvm = spark.sparkContext._jvm
        self.path = lambda name: jvm.org.apache.hadoop.fs.Path(f"{root}/{name}")
        self.fs = self.path("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self.jvm = jvm

    def put(self, name: str, text: str) -> bool:
        """Creates a file; False if it is there."""
        try:
            out = self.fs.create(self.path(name), False)
        except Exception as e:
            if "FileAlreadyExists" in str(e) or self.fs.exists(self.path(name)):
                return False
            raise
        out.write(bytearray(text.encode()))
        out.close()
        return True

    def get(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def names(self, folder: str) -> list[str]:
        p = self.path(folder)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(p) if not s.getPath().getName().startswith(".")) if self.fs.exists(p) else []


@dataclass(frozen=True)
class Progress:
    table_oid: int
    slot_generation: int
    status: str = RUNNING
    upper: list[str] | None = None
    last: list[str] | None = None
    pending: list[list[str]] = field(default_factory=list)
    rows: int = 0


class ControlStore:
    def __init__(self, spark: SparkSession, root: str):
        self.files = _Files(spark, root)

    # slots: one file a generation

    def generation(self, slot: str) -> int | None:
        """The slot's generation, or None if it was never recorded."""
        names = self.files.names(f"slots/{slot}")
        return max(map(int, names)) if names else None

    def record(self, slot: str) -> None:
        """Remembers a slot, if it isn't yet."""
        self.files.put(f"slots/{slot}/0", "{}")

    def spend(self, slot: str, generation: int) -> None:
        """Takes the next generation: exactly one more than now, and only one taker."""
        if self.generation(slot) != generation - 1 or not self.files.put(f"slots/{slot}/{generation}", "{}"):
            raise StateError(f"generation {generation} of slot {slot} can't be taken")

    # backfills: one file a step, the last one counts

    def _steps(self, slot: str, table: str) -> list[int]:
        return sorted(int(n) for n in self.files.names(f"backfills/{slot}/{table}"))

    def progress(self, slot: str, table: str) -> Progress | None:
        steps = self._steps(slot, table)
        return Progress(**json.loads(self.files.get(f"backfills/{slot}/{table}/{steps[-1]}"))) if steps else None

    def _put(self, slot: str, table: str, p: Progress) -> Progress:
        steps = self._steps(slot, table)
        if not self.files.put(f"backfills/{slot}/{table}/{steps[-1] + 1 if steps else 0}", json.dumps(asdict(p))):
            raise StateError(f"the backfill of {table} is written by another")
        return p

    def register(self, slot: str, table: str, oid: int, generation: int) -> Progress:
        """Where to go on. Another table of that name, or another generation of the slot, starts anew."""
        p = self.progress(slot, table)
        return p if p and (p.table_oid, p.slot_generation) == (oid, generation) else self._put(slot, table, Progress(oid, generation))

    def save_upper(self, slot: str, table: str, upper: list[str]) -> None:
        self._put(slot, table, replace(self.progress(slot, table), upper=upper))

    def save(self, slot: str, table: str, last: list[str], rows: int) -> None:
        """After a chunk is delivered, never before."""
        p = self.progress(slot, table)
        self._put(slot, table, replace(p, last=last, rows=p.rows + rows))

    def park(self, slot: str, table: str, keys: Iterable[list[str]]) -> None:
        """Keys to read again later; of a table that hasn't started or is done, nothing changes."""
        p = self.progress(slot, table)
        if p and p.status != DONE:
            self._put(slot, table, replace(p, pending=[*p.pending, *keys]))

    def clear_pending(self, slot: str, table: str) -> None:
        self._put(slot, table, replace(self.progress(slot, table), pending=[]))

    def finish(self, slot: str, table: str) -> None:
        self._put(slot, table, replace(self.progress(slot, table), status=DONE, pending=[]))


def decide(exists: bool, generation: int | None, requested: int) -> str:
    """The policy of a process start; see operators.control.slot_action for the same as an expression."""
    if exists:
        return "keep" if generation is not None else "adopt"
    if generation is None:
        return "create"
    return "recreate" if requested == generation + 1 else "refuse"


def bootstrap(store: ControlStore, slot: str, exists: bool, requested: int, create) -> str:
    """Brings slot and memory together; `create` makes the slot.

    A new slot is made before it is remembered: a crash between leaves a slot to adopt. A lost one is remembered as accepted before it is made anew:
    a crash between must not ask for the same generation twice. A generation that is named though nothing was lost is spent as well.
    """
    generation = store.generation(slot)
    action = decide(exists, generation, requested)
    if action == "refuse":
        raise SlotUnusable(f"slot {slot} is gone and with it changes; go on without them by naming generation {generation + 1}")
    if action == "create":
        create()
    if action in ("create", "adopt"):
        store.record(slot)
    if action == "recreate":
        store.spend(slot, requested)
        create()
    if action == "keep" and requested == generation + 1:
        store.spend(slot, requested)
    return action


def check_slot(slot: str, plugin: str | None, wal_status: str | None) -> bool:
    """Whether the slot is there (plugin is None if not); one that can't serve changes any more, or decodes in another format, is an error."""
    if plugin is None:
        return False
    if plugin != "pgoutput":
        raise SlotUnusable(f"slot {slot} decodes with {plugin}")
    if wal_status == "lost":
        raise SlotUnusable(f"slot {slot} has lost changes that were never read")
    return True


def require_slot(store: ControlStore, slot: str, generation: int, exists: bool) -> None:
    """On every reconnect: the slot that this process began with must still be there, in the same generation."""
    if not exists:
        raise SlotUnusable(f"slot {slot} went away while it was in use")
    if (now := store.generation(slot)) != generation:
        raise StateError(f"slot {slot} is in generation {now}, this process began in {generation}")


def create_slot(slot: str, create: Callable[[str], int], store: ControlStore, generation: int = 0) -> int:
    """Makes the slot and gives the position that its changes begin at; made before it is remembered, as in bootstrap."""
    begins = create(slot)
    if generation:
        store.spend(slot, generation)
    else:
        store.record(slot)
    return begins


def ensure_publication(there: tuple[bool, Iterable[str]] | None, wanted: Iterable[str], create: Callable[[list[str]], None]) -> str:
    """created, kept, or drifted. There: whether it publishes all tables, and which. One that is there is never altered, only reported on."""
    name = lambda t: t if "." in t else f"public.{t}"
    wanted = sorted(map(name, wanted))
    if there is None:
        create(wanted)
        return "created"
    every, listed = there
    same = not wanted if every else bool(wanted) and wanted == sorted(listed)
    return "kept" if same else "drifted"


def check_source(standby: bool, system: str, known: str | None) -> str:
    """A backfill reads the very database that the stream comes from: not a standby, the same system. Returns what to remember."""
    if standby:
        raise StateError("the source is a standby: its snapshots can't be told apart by transaction")
    if known is not None and system != known:
        raise StateError(f"the source is system {system}, the stream comes from {known}")
    return system


def tables_to_copy(listed: tuple[str, ...], published: Iterable[str], own_schema: str) -> list[str]:
    """Named tables, or all published ones but the engine's own; names with dots inside can't be told apart and are refused."""
    if listed != ("all",):
        return [t if "." in t else f"public.{t}" for t in listed]
    out = sorted(t for t in published if t.partition(".")[0] != own_schema)
    if any(t.count(".") != 1 for t in out):
        raise StateError("a table's name has a dot")
    return out
