"""Snapshot merges: one full outer join of the current table and the snapshots of all scopes."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metafleet.functions.keys import item_id, name_key, row_hash
from metafleet.sources.scratch import written

BOOKKEEPING = ("_RowHash", "_InsertDate", "_ModifyDate")


@dataclass
class Merge:
    """``rows``: keys, ``_action`` (insert, update, delete, same, keep) and the row ``before`` and ``after`` as structs."""

    rows: DataFrame
    keys: list[str]

    def once(self) -> Merge:
        """The same merge, its rows written to the shared folder: table, changes and history read them without joining again.

        Keys are written in the versions only.
        """
        inside = set.intersection(*(set(self.rows.schema[c].dataType.fieldNames()) for c in ("before", "after")))
        rows = written(self.rows.drop(*(k for k in self.keys if k in inside)), "merge")
        return Merge(rows.withColumns({k: F.coalesce(f"after.{k}", f"before.{k}") for k in self.keys if k in inside}).select(*self.rows.columns), self.keys)

    def next(self) -> DataFrame:
        """The table after the merge."""
        return self.rows.where("_action <> 'delete'").select("after.*")

    def changes(self) -> DataFrame:
        """What the merge did, with both versions of each row."""
        return self.rows.where("_action IN ('insert', 'update', 'delete')")

    def counts(self) -> DataFrame:
        return self.rows.groupBy("_action").agg(F.count("*").alias("n"))


def hashed(snapshot: DataFrame, scope: Sequence[str], keys: Sequence[str], volatile: Sequence[str] = ()) -> DataFrame:
    """Adds ``_RowHash`` over all columns but the keys' and the volatile ones."""
    return snapshot.withColumn("_RowHash", row_hash(c for c in snapshot.columns if c not in {*scope, *keys, *volatile}))


def first_load(snapshot: DataFrame, scope: Sequence[str], keys: Sequence[str], as_of, volatile: Sequence[str] = ()) -> DataFrame:
    """A current table from the first snapshot."""
    return hashed(snapshot, scope, keys, volatile).withColumns({"_InsertDate": F.lit(as_of), "_ModifyDate": F.lit(as_of)})


def scopes_of(df: DataFrame, scope: Sequence[str]) -> DataFrame:
    """The scopes in ``df``, written: Spark sees how few they are and sends them to the rows, which would
    else be dealt by scope, all rows of a scope to one task."""
    return written(df.select(*scope).distinct(), "scopes")


def _collected(collected: DataFrame, snapshot: DataFrame, scope: Sequence[str], on_empty: str) -> DataFrame:
    """The scopes whose rows may be deleted; ``on_empty="keep"`` passes over those that came empty."""
    if on_empty not in ("keep", "clear"):
        raise ValueError(f"on_empty is keep or clear, not {on_empty}")
    out = scopes_of(collected, scope)
    if on_empty == "keep":
        out = out.join(scopes_of(snapshot, scope), list(scope), "left_semi")
    return out.withColumn("_collected", F.lit(True))


def merge_snapshot(
    current: DataFrame, snapshot: DataFrame, collected: DataFrame, keys: Sequence[str], as_of, scope: Sequence[str] = ("scope_id",),
    on_empty: str = "keep", on_missing: str = "delete", keep_last: Sequence[str] = (), zero: Sequence[str] = (), volatile: Sequence[str] = (), always: bool = False,
) -> Merge:
    """Merges the snapshots of all collected scopes into ``current`` by row hash.

    Rows of collected scopes that the snapshot lacks are deleted (``on_missing="delete"``) or stay with
    the ``zero`` columns set to 0 (``"zero"``). Rows whose hash differs are updated: ``_InsertDate`` stays,
    ``_ModifyDate`` becomes ``as_of``; columns of ``keep_last`` keep their old value where the new one is
    null. ``always`` updates every row that the snapshot has. Rows of other scopes are kept as they are.
    Keys must be unique on both sides (``rules.duplicate_keys``) and not null.
    """
    on = [*scope, *keys]
    fields, own = ([c for c in df.columns if c not in on] for df in (current, snapshot))
    # Keys go through the join once, and the new hash is made behind it: what is moved and sorted is as little as it can be.
    c, s = current.select(*on, F.struct(*fields).alias("_was")), snapshot.select(*on, F.struct(F.lit(True).alias("_there") if not own else own[0], *own[1:]).alias("_now"))
    joined = c.join(s, on, "full_outer").join(_collected(collected, snapshot, scope, on_empty), list(scope), "left")
    old, new = F.col("_was").isNotNull(), F.col("_now").isNotNull()
    hit = F.coalesce(F.col("_collected"), F.lit(False))
    joined = joined.where(hit | old)
    part = lambda name, side: F.col(name if name in on else f"{side}.{name}").alias(name)
    fresh = row_hash([name for name in own if name not in volatile], lambda name: part(name, "_now"))
    joined = joined.select(
        *on, hit.alias("_hit"), F.when(old, F.struct(*(part(name, "_was") for name in current.columns))).alias("before"),
        F.when(new, F.struct(*(part(name, "_now") for name in snapshot.columns), fresh.alias("_RowHash"))).alias("fresh"),
    )
    old, new, hit = F.col("before").isNotNull(), F.col("fresh").isNotNull(), F.col("_hit")
    changed = F.lit(True) if always else F.col("before._RowHash") != F.col("fresh._RowHash")
    missing = F.lit("update" if on_missing == "zero" else "delete")
    action = F.when(~hit, "keep").when(old & ~new, missing).when(new & ~old, "insert").when(changed, "update").otherwise("same")
    rows = joined.withColumn("_action", action)

    def value(name: str):
        """A column of a row that is inserted or updated; only with ``on_missing="zero"`` the snapshot may lack the row."""
        was, now = F.col(f"before.{name}"), F.col(f"fresh.{name}") if name in (*snapshot.columns, "_RowHash") else None
        if name in on:
            return F.col(name)
        if name == "_InsertDate":
            return F.coalesce(was, F.lit(as_of))
        if name == "_ModifyDate":
            return F.lit(as_of)
        if name in zero:
            return F.when(F.col("fresh").isNull(), F.lit(0).cast(current.schema[name].dataType)).otherwise(now)
        if now is None or name in keep_last:
            return was if now is None else F.coalesce(now, was)
        return now if on_missing == "delete" else F.when(F.col("fresh").isNotNull(), now).otherwise(was)

    # One condition for the whole row: one for each column makes code so long that the JVM never compiles it.
    taken = F.when(F.col("_action").isin("insert", "update"), F.struct(*(value(name).alias(name) for name in current.columns)))
    rows = rows.withColumn("after", taken.when(F.col("_action") != "delete", F.col("before")))
    return Merge(rows.select(*on, "_action", "before", "after"), on)


def merge_counters(current: DataFrame, snapshot: DataFrame, collected: DataFrame, keys: Sequence[str], as_of, keep_last: Sequence[str], scope: Sequence[str] = ("scope_id",), on_empty: str = "keep") -> Merge:
    """``merge_snapshot`` where counters overwrite and times that a restart has cleared keep their last value."""
    return merge_snapshot(current, snapshot, collected, keys, as_of, scope, on_empty, keep_last=keep_last)


def merge_zero_fill(current: DataFrame, snapshot: DataFrame, collected: DataFrame, keys: Sequence[str], as_of, zero: Sequence[str], scope: Sequence[str] = ("scope_id",)) -> Merge:
    """Nothing is deleted or compared: every row of a collected scope is updated, counters of absent keys become 0."""
    return merge_snapshot(current, snapshot, collected, keys, as_of, scope, on_empty="keep", on_missing="zero", zero=zero, always=True)


def replace_scope(current: DataFrame, snapshot: DataFrame, collected: DataFrame, scope: Sequence[str] = ("scope_id",)) -> DataFrame:
    """Simple imports: a collected scope's rows are what its snapshot has, also if that is none."""
    scopes = scopes_of(collected, scope)
    kept = current.join(scopes, list(scope), "left_anti")
    taken = snapshot.join(scopes, list(scope), "left_semi")
    return kept.unionByName(taken.select(*current.columns))


def merge_full(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> Merge:
    """Makes ``target`` equal to ``source``; a row is updated only if a column differs (null equals null)."""
    t, s = (df.select(*keys, F.struct(*target.columns).alias(name)) for df, name in ((target, "before"), (source, "after")))
    joined = t.join(s, list(keys), "full_outer")
    action = F.when(F.col("before").isNull(), "insert").when(F.col("after").isNull(), "delete").when(F.col("before").eqNullSafe(F.col("after")), "same").otherwise("update")
    return Merge(joined.select(*keys, action.alias("_action"), "before", "after"), list(keys))


def upsert_targets(dim: DataFrame, targets: DataFrame, keys: Sequence[str], enabled: str = "is_enabled") -> Merge:
    """New targets come in enabled, returned ones are enabled again, absent ones disabled; none is deleted."""
    t = targets.select(*keys).distinct().withColumn("_listed", F.lit(True))
    joined = dim.select(*keys, F.struct(*dim.columns).alias("before")).join(t, list(keys), "full_outer")
    listed = F.coalesce(F.col("_listed"), F.lit(False))
    after = F.struct(*(listed.alias(c) if c == enabled else F.col(c) if c in keys else F.col(f"before.{c}").alias(c) for c in dim.columns))
    was = F.col(f"before.{enabled}")
    action = F.when(F.col("before").isNull(), "insert").when(was.eqNullSafe(listed), "same").otherwise("update")
    return Merge(joined.select(*keys, action.alias("_action"), "before", after.alias("after")), list(keys))


def with_parents(snapshot: DataFrame, roles: dict[str, Sequence[str]]) -> DataFrame:
    """Adds an id column for each role from the columns that name its item; null if any of them is."""
    for role, columns in roles.items():
        known = F.lit(True)
        for c in columns:
            known = known & F.col(c).isNotNull()
        parts = [name_key(c) if snapshot.schema[c].dataType.typeName() == "string" else F.col(c) for c in columns]
        snapshot = snapshot.withColumn(role, F.when(known, item_id(*parts)))
    return snapshot


def merge_with_parents(
    current: DataFrame, snapshot: DataFrame, collected: DataFrame, roles: dict[str, Sequence[str]], items: DataFrame, keys: Sequence[str], as_of, scope: Sequence[str] = ("scope_id",), **options,
) -> tuple[Merge, DataFrame]:
    """Gives a snapshot its ids (see ``with_parents``) and merges it by ``keys``; also the rows that refer to unknown items.

    ``items`` (object_key): the dimension as ``identity.resolve_objects`` gives it, which makes the same ids
    of the same names. Rows of which a role is named and not in it are left out of the merge.
    """
    rows = with_parents(snapshot, roles)
    known = items.select("object_key").distinct()
    lost = F.lit(False)
    for role in roles:
        there = known.select(F.col("object_key").alias(role), F.lit(True).alias(f"_{role}_there"))
        rows = rows.join(there, role, "left")
        lost = lost | (F.col(role).isNotNull() & F.col(f"_{role}_there").isNull())
    rows = rows.withColumn("_lost", lost).drop(*(f"_{role}_there" for role in roles))
    columns = [c for c in current.columns if c not in BOOKKEEPING]
    merge = merge_snapshot(current, rows.where("not _lost").select(*columns), collected, keys, as_of, scope, **options)
    return merge, rows.where("_lost").drop("_lost")
