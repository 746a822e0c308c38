"""What several operators share: words, internal column names, ranks over all rows."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed values.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def fresh(columns: Iterable[str], name: str) -> str:
    """A column name like ``name`` that none of ``columns`` has, in any letter case."""
    taken = {column.lower() for column in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def word_list(text: Column) -> Column:
    """Words of a text as an array; NULL and blank texts have none."""
    bare = F.btrim(text, F.lit(SPACES))
    words = F.split(bare, SPACE_RUN)
    return F.when(F.length(bare) > 0, words).otherwise(F.array().cast("array<string>"))


def word_count(text: Column) -> Column:
    """Number of words of a text; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def random_key(seed: int, row_id: Column, text: Column) -> Column:
    """32 hex digits that order rows at random but alike in every run.

    They depend on the id, and on the text where there is none.
    """
    name = F.coalesce(row_id.cast("string"), F.md5(text.cast("string").cast("binary")), F.lit(""))
    return F.md5(F.concat(F.lit(f"{seed}:"), name))


def hex_slot(key: Column, slots: Column) -> Column:
    """The slot, 0 to ``slots`` - 1, of a hex key; it rises with the key."""
    head = F.conv(F.substring(key, 1, 8), 16, 10).cast("long")
    return F.shiftright(head * slots, 32)


def group_key(column: Column) -> Column:
    """A string that is equal for equal values, and its own for NULL."""
    return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit(""))


def running_totals(
    rows: DataFrame,
    summary: DataFrame,
    group: str,
    key: str,
    order: list[Column],
    total: str,
    per_group: DataFrame | None = None,
    rows_per_slot: int = 4096,
) -> DataFrame:
    """Add ``<total>_before``, summed over the rows of the group before each row.

    ``key`` is a random hex key, ``order`` begins with it, and ``group`` has no NULL. A
    group may hold any share of the rows: all rows are cut into slots of about
    ``rows_per_slot`` by ranges of the key, sums run within a slot, and a small table
    of slots gives what comes before it. ``summary`` has the group, key and total of the
    same rows. Columns of ``per_group``, one row per group, are joined to the slots
    and so reach the rows without a join of their own, as does ``<total>_all``.
    """
    slot = fresh(rows.columns, "_slot")
    slots = F.greatest(
        F.ceil(summary.agg(F.count(F.lit(1))).scalar() / rows_per_slot), F.lit(1).cast("long")
    )
    before, whole = f"{total}_before", f"{total}_all"
    by_slot = summary.groupBy(group, hex_slot(F.col(key), slots).alias(slot))
    by_slot = by_slot.agg(F.sum(total).alias("_sum"))
    until = (Window.unboundedPreceding, -1)
    earlier = Window.partitionBy(group).orderBy(slot).rowsBetween(*until)
    zero = F.lit(0).cast("long")
    starts = by_slot.select(
        group,
        slot,
        F.coalesce(F.sum("_sum").over(earlier), zero).alias("_start"),
        F.sum("_sum").over(Window.partitionBy(group)).alias(whole),
    )
    if per_group is not None:
        starts = starts.join(per_group, group)
    here = Window.partitionBy(group, slot).orderBy(*order).rowsBetween(*until)
    within = rows.withColumn(slot, hex_slot(F.col(key), slots))
    within = within.withColumn("_within", F.coalesce(F.sum(total).over(here), zero))
    joined = within.join(starts, [group, slot])
    added = [c for c in starts.columns if c not in (group, slot, "_start")]
    return joined.select(*rows.columns, (F.col("_start") + F.col("_within")).alias(before), *added)
