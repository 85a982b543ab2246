"""One run over the whole fleet, driven by the registry: queue, checksum gate, ids, merges by dataset, history, status."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metafleet.operators import history, identity, merge, status
from metafleet.plans.registry import DatasetSpec
from metafleet.sources.landing import Landing
from metafleet.sources.scratch import written

SCOPE = {"instance": ["instance_id"], "database": ["instance_id", "database_id"]}


@dataclass(frozen=True)
class Source:
    """A dataset's ``current`` table, the ``snapshot`` of all scopes, and the ``scopes`` that could be read.

    A ``landing`` takes the place of the snapshot: its digests answer the gate, and only scopes that moved are read. ``checksums``
    (scope, checksum) are what the sources themselves said, if they were asked. ``items`` is the dimension that the dataset defines.
    """

    current: DataFrame
    snapshot: DataFrame | None = None
    scopes: DataFrame | None = None
    landing: Landing | None = None
    checksums: DataFrame | None = None
    items: DataFrame | None = None

    def collected(self, scope: Sequence[str]) -> DataFrame:
        return (self.landing.scopes() if self.landing else self.scopes).select(*scope).distinct()


@dataclass
class SyncRun:
    """What a run leaves: tables, changes and closed versions by dataset, dimensions by their id, rows that refer to unknown
    items, and the status of every task."""

    status: DataFrame
    tables: dict[str, DataFrame] = field(default_factory=dict)
    changes: dict[str, DataFrame] = field(default_factory=dict)
    closed: dict[str, DataFrame] = field(default_factory=dict)
    items: dict[str, DataFrame] = field(default_factory=dict)
    lost: dict[str, DataFrame] = field(default_factory=dict)


def waves(specs: Sequence[DatasetSpec]) -> list[list[DatasetSpec]]:
    """The datasets in waves: each comes after those that it names in ``after``, as early as it can. A circle is an error."""
    names, done, out = {s.name for s in specs}, set(), []
    left = list(specs)
    while left:
        ready = [s for s in left if not (set(s.after) & names) - done]
        if not ready:
            raise ValueError(f"datasets wait for each other: {', '.join(s.name for s in left)}")
        out.append(ready)
        done |= {s.name for s in ready}
        left = [s for s in left if s.name not in done]
    return out


def gated(spec: DatasetSpec, tasks: DataFrame, source: Source) -> DataFrame:
    """(scope, checksum, moved): the queued scopes that could be read; ``moved`` is 1 if their rows must be merged.

    ``tasks``: scope and old_checksum. Datasets without a checksum always run. A scope that was read and has no checksum where the
    dataset has one is an error: its next run would skip a load that never happened.
    """
    scope = SCOPE[spec.level]
    reached = tasks.join(source.collected(scope), scope, "left_semi")
    if not spec.has_checksum:
        return reached.select(*scope, F.lit(None).cast("long").alias("checksum"), F.lit(1).alias("moved"))
    if source.checksums is not None:
        sums = source.checksums
    elif source.landing:
        sums = source.landing.checksums()
    else:
        asked = source.snapshot.join(reached.select(*scope), scope, "left_semi")
        own = [c for c in source.snapshot.columns if c not in {*scope, *spec.volatile, *spec.roles}]
        sums = written(status.dataset_checksum(asked, scope, own, reached), "checksums")
    both = reached.join(sums.select(*scope, F.col("checksum").alias("new_checksum")), scope, "left").withColumn("has_checksum", F.lit(True))
    missing = status.missing_checksums(both).count()
    if missing:
        raise ValueError(f"{spec.name}: {missing} scopes were read and have no checksum")
    must = status.checksum_gate(both).select(*scope, F.lit(1).alias("_must"))
    return both.join(must, scope, "left").select(*scope, F.col("new_checksum").alias("checksum"), F.coalesce("_must", F.lit(0)).alias("moved"))


def with_ids(spec: DatasetSpec, rows: DataFrame) -> DataFrame:
    """The rows with the ids of their roles, written: every later step reads the ids, none hashes names again.

    Ids that a snapshot brings along, made by ``merge.with_parents`` of the same names, are taken as they are.
    """
    return written(merge.with_parents(rows, {role: names for role, names in spec.roles.items() if role not in rows.columns}), "snapshot")


def _merged(spec: DatasetSpec, source: Source, gate: DataFrame, run: SyncRun, now) -> None:
    """Merges one dataset's scopes that must run, by its spec."""
    scope, going = SCOPE[spec.level], gate.where("moved = 1")
    rows = source.landing.rows(gate).drop("_range") if source.landing else source.snapshot.join(going.select(*scope), scope, "left_semi")
    if source.landing or source.checksums is not None:
        rows = with_ids(spec, rows)
    if spec.mode == "simple":
        run.tables[spec.name] = merge.replace_scope(source.current, rows, going, scope)
        return
    if spec.defines:
        # The items that the snapshot names; a collected scope loses those it names no more, unless it came empty.
        kept = [c for c in source.items.columns if c not in ("is_deleted", "delete_date")]
        full = rows.select(*scope).distinct()
        run.items[spec.defines] = written(identity.sync_items(source.items, rows.select(*kept), full, spec.defines, "database_id", now), "items")
    lost = F.lit(False)
    for role, item in spec.refers.items():
        known = run.items[item].where("not is_deleted").select(F.col(item).alias(role))
        # Ids are moved to find the unknown ones, rows are not: of these there are few, which are sent to the rows.
        named = rows.select(role).where(F.col(role).isNotNull()).distinct()
        unknown = written(named.join(known, role, "left_anti").withColumn(f"_{role}", F.lit(True)), "unknown")
        rows = rows.join(unknown, role, "left")
        lost = lost | F.coalesce(F.col(f"_{role}"), F.lit(False))
    if spec.refers:
        rows = rows.withColumn("_lost", lost)
        columns = [c for c in rows.columns if c != "_lost" and c not in {f"_{role}" for role in spec.refers}]
        run.lost[spec.name], rows = rows.where("_lost").select(*columns), rows.where("not _lost").select(*columns)
    rows = rows.select(*[c for c in source.current.columns if c not in merge.BOOKKEEPING])
    options = {"on_missing": "zero", "zero": spec.zero, "always": True} if spec.zero else {"keep_last": spec.keep_last}
    done = merge.merge_snapshot(source.current, rows, going, spec.keys, now, scope, on_empty=spec.on_empty, volatile=spec.volatile, **options).once()
    run.tables[spec.name], run.changes[spec.name] = done.next(), done.changes()
    if spec.versioned:
        run.closed[spec.name] = history.history_append(done, now)


def _all(jobs: list[Callable[[], None]], session, threads: int) -> None:
    """Runs the jobs side by side, each in a scheduler pool of its own; the first error ends the run."""
    context = session.sparkContext

    def pooled(k: int, job: Callable[[], None]) -> Callable[[], None]:
        def go() -> None:
            context.setLocalProperty("spark.scheduler.pool", f"dataset-{k}")
            try:
                job()
            finally:
                context.setLocalProperty("spark.scheduler.pool", None)

        return inheritable_thread_target(session)(go)

    with ThreadPoolExecutor(max_workers=max(1, threads)) as pool:
        for done in [pool.submit(pooled(k, job)) for k, job in enumerate(jobs)]:
            done.result()


def sync_run(specs: Sequence[DatasetSpec], matrix: DataFrame, known: DataFrame, sources: dict[str, Source], now, unreachable: DataFrame | None = None, threads: int = 4) -> SyncRun:
    """Runs the stale tasks of ``matrix`` (see ``status.task_matrix``; dataset_id is the place in ``specs``, from 1 on).

    Datasets run side by side, after those that they name in ``after``. A merge is computed once, and table, changes and
    history read it. A merged dataset's scope that came empty keeps its rows, a replaced one's is emptied. A queued scope that a
    source could not read gets an error and waits for its next turn; a scope in ``unreachable`` (instance_id, database_id,
    message) gets one for every dataset that it has, queued or not.
    """
    session = matrix.sparkSession
    queue = status.stale_queue(matrix, now)
    if unreachable is not None:
        queue = queue.alias("q").join(unreachable.alias("u"), (F.col("q.instance_id") == F.col("u.instance_id")) & F.col("q.database_id").eqNullSafe(F.col("u.database_id")), "left_anti")
    queue = written(queue, "queue")
    run, events, place = SyncRun(known), {}, {spec.name: k for k, spec in enumerate(specs, 1)}

    def job(spec: DatasetSpec) -> Callable[[], None]:
        def go() -> None:
            k, scope, source = place[spec.name], SCOPE[spec.level], sources[spec.name]
            tasks = queue.where(F.col("dataset_id") == k).select(*scope, F.col("checksum").alias("old_checksum"))
            if source.checksums is None and not source.landing:
                # Computed once, so that checksums, items and merge see the same rows.
                source = replace(source, snapshot=with_ids(spec, source.snapshot.join(tasks.select(*scope), scope, "left_semi")))
            gate = written(gated(spec, tasks, source), "gate")
            _merged(spec, source, gate, run, now)
            missed = tasks.join(gate.select(*scope), scope, "left_anti").select(*scope, F.lit(None).cast("long").alias("checksum"), F.lit("not collected").alias("error_message"))
            both = gate.select(*scope, "checksum", F.lit(None).cast("string").alias("error_message")).unionByName(missed)
            database = F.col("database_id") if spec.level == "database" else F.lit(None)
            events[k] = both.select(F.col("instance_id").cast("int").alias("instance_id"), database.cast("int").alias("database_id"), F.lit(k).alias("dataset_id"), F.lit(now).alias("ts"), F.lit(k).cast("long").alias("event_id"), "checksum", "error_message")

        return go

    for wave in waves(specs):
        _all([job(spec) for spec in wave], session, threads)
    all_events = events[1]
    for k in range(2, len(specs) + 1):
        all_events = all_events.unionByName(events[k])
    run.status = status.status_apply(known, all_events)
    if unreachable is not None:
        run.status = status.status_scope_error(run.status, matrix, unreachable.withColumn("ts", F.lit(now)))
    return run
