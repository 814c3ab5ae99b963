"""Per-user rolling features over the last rows of a user."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

from ctrflow.schema import ENGINEERED, ID, TARGET, TIME, USER, spare_names
from ctrflow.session import stage

FRAME_ROWS = 24
#: Cuts of a user that lie in one run, to find a place among many.
RUN = 64
#: A user is busy with more than this part of the rows of a range.
BUSY = 4


def top_value(value: str, clicked: str | None, window) -> Column:
    """Value with most clicks in the frame if it has a click, else the most frequent value.

    ``mode`` ignores nulls, so the mode of the clicked rows is null exactly when there is no
    click. Ties go to the lowest value.
    """
    frequent = F.mode(value, True).over(window)
    if clicked is None:
        return frequent
    return F.coalesce(F.mode(F.when(F.col(clicked) == 1, F.col(value)), True).over(window), frequent)


def rolling_top(
    df: DataFrame,
    columns: Mapping[str, str] = ENGINEERED,
    *,
    user: str = USER,
    time: str = TIME,
    row_id: str = ID,
    clicked: str | None = TARGET,
    frame_rows: int = FRAME_ROWS,
    include_current: bool = True,
    parts: int | None = None,
) -> DataFrame:
    """Adds, per source column, the rolling top value of the user's last ``frame_rows`` rows.

    ``clicked=None`` leaves the clicks aside (plain frequency). The rows of a user are ordered by
    time, row id and, where both are equal, by the values themselves, nulls first; frames at the
    start are shorter. Rows without a user are those of one more user. All columns share one
    shuffle and sort.

    A window is one task per user, so the keys of busy users are dealt to ranges of about equal size, a
    ``parts``-th of all rows (as many as shuffle partitions), and a user whom ranges cut is one window
    per range. Users with at most a quarter of such a range are never cut. Frames
    of the first rows of a range reach back into earlier ones: these rows, and the last ones of each
    range, are a few per range, and one more window over just them gives the frames that were cut.
    Where the ranges lie changes no result.
    """
    last = 0 if include_current else -1
    first = last - (frame_rows - 1)
    reach = -first
    names = df.columns
    order = list(dict.fromkeys([time, row_id, *columns, *([clicked] if clicked else [])]))
    at, cuts, part, head, tail = spare_names(df, "_at", "_cuts", "_part", "_head", "_tail")
    by_user = Window.partitionBy(user).orderBy(*order)

    def featured(of: DataFrame, window, *more: str) -> DataFrame:
        frame = window.rowsBetween(first, last)
        added = of.withColumns({name: top_value(c, clicked, frame) for c, name in columns.items()})
        return added.select(*[c for c in names if c not in columns.values()], *columns.values(), *more)

    table = _cut_users(df, user, order, parts, at, cuts)
    if table is None:
        return featured(df, by_user)

    owner = spare_names(df, "_owner")[0]
    rows = df.join(F.broadcast(table.withColumnRenamed(user, owner)), F.col(user).eqNullSafe(F.col(owner)), "left").drop(owner)
    rows = rows.withColumn(part, _place(F.struct(*order), F.col(cuts))).drop(cuts)
    in_part = Window.partitionBy(user, part).orderBy(*order)
    numbered = rows.withColumns({
        head: (F.col(part) > 0) & (F.row_number().over(in_part) <= reach),
        tail: (F.col(part) >= 0) & F.lead(F.lit(1), max(reach, 1)).over(in_part).isNull(),
    })
    # Both read the same exchange of the rows.
    inner = featured(numbered, in_part, head).where(~F.col(head))
    # Of a cut user the edges of all ranges; what lies before a head is there, up to its reach.
    edges = featured(numbered.where(F.col(head) | F.col(tail)), by_user, head).where(head)
    return inner.unionByName(edges).drop(head)


def _cut_users(df: DataFrame, user: str, order: list[str], parts: int | None, at: str, cuts: str) -> DataFrame | None:
    """(user, sorted keys at which later ranges begin, in runs of ``RUN``) of the users whom ranges cut; fewer rows than ranges.

    Only keys of busy users are sorted into ranges; the others fit into a part of a range. The table is stored, so the cuts are the
    same for all that use them. None where no user can be cut.
    """
    number, low, high, before, rows, owner = spare_names(df, "_range", "_low", "_high", "_before", "_rows", "_owner")
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tally = stage(df.groupBy(user).agg(F.count(F.lit(1)).alias(rows)), "users")
    total = tally.agg(F.sum(rows)).first()[0] or 0
    busy = tally.where(F.col(rows) > total / (BUSY * parts))  # fewer than BUSY x parts users
    held = busy.agg(F.sum(rows)).first()[0] or 0
    # Ranges of a parts-th of all rows, rounded up.
    ranges = -(-held * parts // max(total, 1))
    if ranges < 2:
        return None
    known = F.broadcast(busy.select(F.col(user).alias(owner)))
    keys = df.join(known, F.col(user).eqNullSafe(F.col(owner)), "left_semi").select(user, F.struct(*order).alias(at))
    keys = keys.repartitionByRange(ranges, user, at)
    key = F.struct(F.col(user).alias("user"), F.col(at).alias("at"))
    ends = keys.withColumn(number, F.spark_partition_id()).groupBy(number).agg(F.min(key).alias(low), F.max(key).alias(high))
    # One row per range, so this window is small.
    following = ends.withColumn(before, F.lag(high).over(Window.partitionBy(F.lit(0)).orderBy(number)))
    cut = following.where(F.col(before).isNotNull() & F.col(f"{before}.user").eqNullSafe(F.col(f"{low}.user")))
    sorted_ = cut.groupBy(F.col(f"{low}.user").alias(user)).agg(F.sort_array(F.collect_list(f"{low}.at")).alias(cuts))
    runs = F.transform(F.sequence(F.lit(0), F.floor((F.size(cuts) - 1) / RUN).cast("int")), lambda i: F.slice(cuts, i * RUN + 1, RUN))
    return stage(sorted_.withColumn(cuts, runs), "cuts")


def _place(key: Column, cuts: Column) -> Column:
    """How many of the sorted cuts are at or below the key, run of cuts by run; -1 without cuts."""
    passed = F.size(F.filter(cuts, lambda run: F.get(run, F.lit(0)) <= key))
    within = F.size(F.filter(F.get(cuts, passed - 1), lambda cut: cut <= key))
    return F.when(cuts.isNull(), -1).when(passed == 0, 0).otherwise((passed - 1) * RUN + within)
