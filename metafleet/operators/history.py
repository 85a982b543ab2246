"""Row history as closed validity intervals, and reads at a time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metafleet.operators.merge import Merge


def history_append(merge: Merge, as_of) -> DataFrame:
    """The versions that a merge closed, valid from their last change to ``as_of`` (exclusive).

    ``_month`` (year and month of the end, as 202401) is there to partition the files by, so that
    ``expire_history`` reads no folder that is too old.
    """
    closed = merge.rows.where("_action IN ('update', 'delete')").select("before.*")
    ended = closed.withColumns({"_ValidFrom": F.col("_ModifyDate"), "_ValidTo": F.lit(as_of).cast(closed.schema["_ModifyDate"].dataType)})
    return ended.withColumn("_month", month("_ValidTo"))


def month(t) -> Column:
    """Year and month of a time as a number: 202401."""
    return F.year(t) * 100 + F.month(t)


def all_versions(current: DataFrame, history: DataFrame) -> DataFrame:
    """Every version; ``_ValidTo`` is null for those still valid."""
    kind = history.schema["_ValidTo"].dataType
    live = current.withColumns({"_ValidFrom": F.col("_ModifyDate"), "_ValidTo": F.lit(None).cast(kind)})
    return live.unionByName(history.select(*live.columns))


def as_of(current: DataFrame, history: DataFrame, t) -> DataFrame:
    """The rows as they were at ``t``."""
    at = F.lit(t)
    rows = all_versions(current, history).where((F.col("_ValidFrom") <= at) & (F.col("_ValidTo").isNull() | (F.col("_ValidTo") > at)))
    return rows.drop("_ValidFrom", "_ValidTo")


def between(current: DataFrame, history: DataFrame, start, end) -> DataFrame:
    """All versions that were valid at some time from ``start`` to ``end``, both included."""
    return all_versions(current, history).where((F.col("_ValidFrom") <= F.lit(end)) & (F.col("_ValidTo").isNull() | (F.col("_ValidTo") > F.lit(start))))


def expire_history(history: DataFrame, now, months: int = 6) -> DataFrame:
    """Without the versions that ended longer ago than so many months, to the second."""
    first = F.lit(now).cast(history.schema["_ValidTo"].dataType) - F.make_interval(months=F.lit(months))
    kept = history.where(F.col("_ValidTo") >= first)
    return kept.where(F.col("_month") >= month(first)) if "_month" in history.columns else kept


def replay(changes: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The current table from its change log (with ``order``, the run's time): the last change of each key wins."""
    last = changes.groupBy(*keys).agg(F.max_by(F.struct("_action", "after"), F.col(order)).alias("last"))
    return last.where("last._action <> 'delete'").select("last.after.*")


def _months(from_, to) -> Column:
    """The numbers of the months that an interval touches; its end is not part of it."""
    number = lambda t: F.year(t) * 12 + F.month(t)
    return F.sequence(number(from_), F.greatest(number(from_), number(to - F.expr("INTERVAL '0.000001' SECOND"))))


#: Versions of a key from which on its history is long: its pairs are found month by month. The pairs of a shorter one are looked
#: at one by one, fewer than so many for each version.
LONG = 512
#: The cut of a version that is not cut, no month's number.
_WHOLE = -(1 << 31)


def _long_keys(sides: list[DataFrame], keys: list[str], long: int) -> DataFrame:
    """The keys of which a side has ``long`` versions or more, few by that: each stands for as many rows."""
    found = [df.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") >= long).select(*keys) for df in sides]
    return found[0].unionByName(found[1]).distinct().withColumn("_long", F.lit(True))


def temporal_join(left: DataFrame, right: DataFrame, keys: list[str], horizon, long: int = LONG) -> DataFrame:
    """Two tables of versions (keys, ..., ``_ValidFrom``, ``_ValidTo``) joined where both were valid at once.

    ``_ValidFrom`` and ``_ValidTo`` of a row are those of the common time; versions still valid last to ``horizon`` and have a null
    end where both do. Other columns of the right side that the left has too are called ``right_...``. Versions meet by their key
    in an equi-join. Those of keys with a history of ``long`` versions or more are cut to months and meet by key and month, so that no
    key's pairs grow with the square of its history; a pair comes out in the first month that both touch, and once. All other
    versions are moved once, however many months they last. Versions of no duration meet nothing.
    """
    end = F.lit(horizon).cast(left.schema["_ValidTo"].dataType)
    lasting = [df.where(F.col("_ValidFrom") < F.coalesce("_ValidTo", end)) for df in (left, right)]
    many = F.broadcast(_long_keys(lasting, keys, long))

    def side(df: DataFrame, name: str) -> DataFrame:
        rest = [c for c in df.columns if c not in (*keys, "_ValidFrom", "_ValidTo")]
        rows = df.withColumns({f"_from_{name}": F.col("_ValidFrom"), f"_to_{name}": F.coalesce("_ValidTo", end), f"_open_{name}": F.col("_ValidTo").isNull()})
        months = F.when(F.col("_long"), _months(F.col(f"_from_{name}"), F.col(f"_to_{name}"))).otherwise(F.array(F.lit(_WHOLE)))
        rows = rows.join(many, keys, "left").withColumn("_cut", F.explode(months))
        taken = set(left.columns) if name == "r" else set()
        return rows.select(*keys, "_cut", *(F.col(f"_{c}_{name}") for c in ("from", "to", "open")), *(F.col(c).alias(f"right_{c}" if c in taken else c) for c in rest))

    both = side(lasting[0], "l").join(side(lasting[1], "r"), [*keys, "_cut"])
    start, stop = F.greatest("_from_l", "_from_r"), F.least("_to_l", "_to_r")
    first = (F.col("_cut") == _WHOLE) | (F.col("_cut") == F.year(start) * 12 + F.month(start))
    found = both.where((start < stop) & first).withColumns({"_ValidFrom": start, "_ValidTo": F.when(~(F.col("_open_l") & F.col("_open_r")), stop)})
    return found.drop("_cut", *(f"_{c}_{s}" for c in ("from", "to", "open") for s in "lr"))
