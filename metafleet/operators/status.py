"""What was collected when: the task matrix, the queue, checksum gates and status folding."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metafleet.functions.keys import row_checksum, stale_minutes

KEY = ("instance_id", "database_id", "dataset_id")
STATE = {"checksum": "long", "last_sync": "timestamp_ntz", "last_check": "timestamp_ntz", "last_error": "timestamp_ntz", "error_message": "string"}


def _on(left: str, right: str):
    """Null-safe on the database only: it is null for datasets of instance level."""
    return (F.col(f"{left}.instance_id") == F.col(f"{right}.instance_id")) & F.col(f"{left}.database_id").eqNullSafe(F.col(f"{right}.database_id")) & (F.col(f"{left}.dataset_id") == F.col(f"{right}.dataset_id"))


def task_matrix(specs: DataFrame, instances: DataFrame, databases: DataFrame, status: DataFrame) -> DataFrame:
    """Every enabled scope with every enabled dataset of its level, and its status if any.

    ``specs``: dataset_id, level (instance or database), is_enabled, minutes. The registry has a row per
    dataset, so it is paired by the level as an ordinary join.
    """
    on = instances.where("is_enabled").select("instance_id")
    scopes = on.select("instance_id", F.lit(None).cast("int").alias("database_id"), F.lit("instance").alias("level")).unionByName(
        databases.where("is_enabled").join(on, "instance_id", "left_semi").select("instance_id", F.col("database_id").cast("int").alias("database_id"), F.lit("database").alias("level"))
    )
    tasks = scopes.join(specs.where("is_enabled").select("dataset_id", "level", "minutes"), "level").alias("t")
    return tasks.join(status.alias("s"), _on("t", "s"), "left").select("t.*", *(F.col(f"s.{c}") for c in STATE))


def stale_queue(matrix: DataFrame, now) -> DataFrame:
    """Tasks that were never checked or whose last check is their dataset's stale age ago, or longer."""
    age = stale_minutes("last_check", F.lit(now))
    return matrix.where(F.col("last_check").isNull() | (F.col("minutes") <= age))


def queue_summary(queue: DataFrame) -> DataFrame:
    """Tasks of each instance and database, most first for a reader who sorts."""
    return queue.groupBy("instance_id", "database_id").agg(F.count("*").alias("tasks"))


def largest_first(queue: DataFrame) -> DataFrame:
    """Databases and tasks of each instance, the instance with most databases first."""
    totals = queue_summary(queue).groupBy("instance_id").agg(F.count("*").alias("scopes"), F.sum("tasks").alias("tasks"))
    return totals.orderBy(F.desc("scopes"), "instance_id")


def run_totals(queue: DataFrame) -> DataFrame:
    """One row: instances, scopes and tasks of a run."""
    return queue_summary(queue).agg(F.countDistinct("instance_id").alias("instances"), F.count("*").alias("scopes"), F.coalesce(F.sum("tasks"), F.lit(0)).alias("tasks"))


def dataset_checksum(snapshot: DataFrame, scope: Sequence[str], columns: Sequence[str], scopes: DataFrame | None = None) -> DataFrame:
    """(scope, n_rows, checksum): order-free, and equal rows don't cancel. Scopes without rows have 0 and 0.

    The checksum is the rows' sum modulo 2 ** 62.
    """
    # The halves of 30 bits are summed as longs, which is much cheaper than a sum of decimals.
    rows = snapshot.select(*scope, row_checksum(columns).alias("_sum"))
    high, low = (F.sum(half).cast("decimal(38,0)") for half in (F.shiftright("_sum", 30), F.col("_sum").bitwiseAND((1 << 30) - 1)))
    total = (high * F.lit(1 << 30).cast("decimal(11,0)") + low) % F.lit(1 << 62)
    sums = rows.groupBy(*scope).agg(F.count("*").alias("n_rows"), total.cast("long").alias("checksum"))
    if scopes is None:
        return sums
    out = scopes.select(*scope).distinct().join(sums, list(scope), "left")
    return out.select(*scope, F.coalesce("n_rows", F.lit(0)).alias("n_rows"), F.coalesce("checksum", F.lit(0).cast("long")).alias("checksum"))


def checksum_gate(tasks: DataFrame) -> DataFrame:
    """Tasks (old_checksum, new_checksum, has_checksum) that must run: no checksum, none known, or another one.

    Join the result to the snapshots (``left_semi``) so that skipped scopes are never scanned.
    """
    return tasks.where(~F.col("has_checksum") | F.col("old_checksum").isNull() | (F.col("new_checksum") != F.col("old_checksum")))


def missing_checksums(tasks: DataFrame) -> DataFrame:
    """Tasks whose dataset has a checksum and whose source gave none: an error."""
    return tasks.where(F.col("has_checksum") & F.col("new_checksum").isNull())


def status_apply(status: DataFrame, events: DataFrame) -> DataFrame:
    """Folds events (KEY, ts, event_id, checksum, error_message) into the status, in order of time.

    A success sets checksum and check time, and the sync time if the checksum is another or there is
    none; a failure sets check time, error time and message and leaves the checksum alone. So the state
    after many events is: the checksum of the last success, the time of the last event, the last
    failure's time and message, and the last success whose checksum differs from the success before.
    A failure without a status leaves no checksum, so that the next run doesn't skip the load.
    """
    from pyspark.sql import Window

    e = events.withColumns({"ok": F.col("error_message").isNull(), "at": F.struct("ts", "event_id")})
    known = status.select(*KEY, F.col("checksum").alias("was"))
    e = e.alias("e").join(known.alias("k"), _on("e", "k"), "left").select("e.*", "k.was")
    # The success before: within the events, or else the status. A group is one task's events of one run.
    order = Window.partitionBy(*KEY, "ok").orderBy("ts", "event_id")
    e = e.withColumn("before", F.when(F.row_number().over(order) == 1, F.col("was")).otherwise(F.lag("checksum").over(order)))
    moved = F.col("ok") & (F.col("checksum").isNull() | F.col("before").isNull() | (F.col("checksum") != F.col("before")))
    folded = e.groupBy(*KEY).agg(
        F.max_by(F.when(F.col("ok"), F.struct(F.col("checksum").alias("c"))), F.when(F.col("ok"), F.col("at"))).alias("success"),
        F.max("ts").alias("checked"), F.max(F.when(moved, F.col("ts"))).alias("synced"),
        F.max_by("error_message", F.when(~F.col("ok"), F.col("at"))).alias("message"), F.max(F.when(~F.col("ok"), F.col("ts"))).alias("failed"),
    )
    j = status.alias("s").join(folded.alias("f"), _on("s", "f"), "full_outer")
    pick = lambda new, old: F.coalesce(F.col(f"f.{new}"), F.col(f"s.{old}")).alias(old)
    checksum = F.when(F.col("f.success").isNotNull(), F.col("f.success.c")).otherwise(F.col("s.checksum")).alias("checksum")
    keys = [F.coalesce(F.col(f"s.{k}"), F.col(f"f.{k}")).alias(k) for k in KEY]
    return j.select(*keys, checksum, pick("synced", "last_sync"), pick("checked", "last_check"), pick("failed", "last_error"), pick("message", "error_message"))


def status_scope_error(status: DataFrame, matrix: DataFrame, errors: DataFrame) -> DataFrame:
    """A scope that can't be reached (instance_id, database_id, ts, message) pushes back all of its tasks.

    Every dataset of the scope gets the error, also those without a status; their sync time stays null.
    """
    e = errors.alias("e")
    hit = matrix.alias("m").join(e, (F.col("m.instance_id") == F.col("e.instance_id")) & F.col("m.database_id").eqNullSafe(F.col("e.database_id")))
    events = hit.select(*(f"m.{k}" for k in KEY), F.col("e.ts").alias("ts"), F.lit(0).cast("long").alias("event_id"), F.lit(None).cast("long").alias("checksum"), F.col("e.message").alias("error_message"))
    return status_apply(status, events)


def force_sync(status: DataFrame, tasks: DataFrame) -> DataFrame:
    """Clears checksum and check time of the named tasks, so that the next run takes them."""
    hit = status.alias("s").join(tasks.select(*KEY).distinct().withColumn("_hit", F.lit(True)).alias("t"), _on("s", "t"), "left")
    clear = lambda c: F.when(F.col("t._hit").isNull(), F.col(f"s.{c}")).alias(c)
    return hit.select(*(f"s.{k}" for k in KEY), *(clear(c) if c in ("checksum", "last_check") else F.col(f"s.{c}") for c in STATE))
