"""Splitting hot keys of an ordered, keyed frame into chunks.

The alarm operators walk the rows of one gateway or data point in time order.
A plain ``Window.partitionBy(key)`` puts all rows of a key into one task, which
fails when one key holds a large share of the table.  ``split_hot_keys`` counts the
rows of every key and cuts the time of each hot one into cells, so that (key, cell)
can be shuffled instead of the key.

Cells start at equal widths and are counted; a cell that still holds too many rows (a
burst) is cut again, into ``CUTS`` parts, until none does or cells are one microsecond
wide; rows of one microsecond are cut by their tie in the same way, a text by seven bytes at
a time, as many as it takes.  Only rows alike in key, time and whole tie, which have no order,
stay together whatever their number.  Which rows are hot is
decided by counts of all rows, never by an estimate; where there are too few rows in all
for any key to be hot, keys are not counted.  Keys
and cells that are cut are tables in the shared folder, joined like any other table:
there is no bound on how many there are, nothing of them reaches the driver, and every
evaluation of the plan, also after a lost executor, sees the same chunks.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alarmloom.storage import written

CHUNK = "__chunk"
CUTS = 64


@dataclass(frozen=True)
class SplitPolicy:
    """target_rows: most rows of a chunk; keys above twice this are split."""

    target_rows: int = 4_000_000


DEFAULT_POLICY = SplitPolicy()

# For frames derived from rows that were split (or found to need no split) before.
# Splitting the source once and carrying ``__chunk`` through joins and filters is
# cheaper than counting every derived frame, and stays valid as long as the derived
# keys extend the split keys and the order of the rows is kept.
CHECKED = SplitPolicy()


def split_hot_keys(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    tie: str,
    policy: SplitPolicy = DEFAULT_POLICY,
) -> tuple[DataFrame, bool]:
    """Add ``__chunk`` when some key is hot.

    Returns the frame and whether it is split.  When it is, ``__chunk`` is null for
    keys that are not hot and a text that rises with (ts, tie) for hot ones.  A frame
    that already has the column is left as it is.
    """
    keys = list(keys)
    if CHUNK in df.columns:
        return df, True
    if policy is CHECKED:
        return df, False
    target = policy.target_rows
    # a plain count needs neither the keys nor what is computed of them
    if df.count() <= 2 * target:
        return df, False
    timed = df.withColumn("__t", F.unix_micros(F.col(ts)))
    by_time = _cells(timed, keys, "__t", F.lit(True), 2 * target, target)
    if by_time is None:
        return df, False
    # what is left of a burst in one microsecond is cut by the tie
    split = by_time.withColumnsRenamed({"__cell": "__t0", "__width": "__w0"})
    levels = ["__t0"]
    for number in _numbers(df, tie):
        last = len(levels)
        one = F.col(f"__w{last - 1}") == 1
        numbered = split.withColumn("__u", number)
        cut = _cells(numbered, [*keys, *levels], "__u", one, target, target, tie)
        if cut is None:
            break
        split = cut.withColumnsRenamed({"__cell": f"__t{last}", "__width": f"__w{last}"})
        levels.append(f"__t{last}")
    finer = [F.coalesce(_sortable(level), F.lit("")) for level in levels[1:]]
    label = F.concat(_sortable("__t0"), *finer)
    return split.select(*df.columns, label.alias(CHUNK)), True


def _numbers(df: DataFrame, name: str) -> Iterator[Column]:
    """Whole numbers that rise with a column, each where the ones before are equal."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.StringType):
        yield _seven_bytes(name, 1)
        longest = df.agg(F.max(F.octet_length(name))).first()[0] or 0
        for at in range(8, longest + 1, 7):
            yield _seven_bytes(name, at)
    elif isinstance(kind, T.DateType):
        yield F.unix_date(name).cast("long")
    elif isinstance(kind, T.TimestampType):
        yield F.unix_micros(name)
    else:
        yield F.col(name).cast("long")


def _seven_bytes(name: str, at: int) -> Column:
    part = F.hex(F.substring(F.encode(F.col(name), "utf-8"), at, 7))
    return F.conv(F.rpad(part, 14, "0"), 16, 10).cast("long")


def _sortable(name: str) -> Column:
    """A whole number as a text that sorts like it."""
    return F.lpad(F.hex(F.col(name).bitwiseXOR(F.lit(-(2**63)))), 16, "0")


def _cells(
    df: DataFrame,
    keys: list[str],
    value: str,
    which: Column,
    least: int,
    target: int,
    whole: str | None = None,
) -> DataFrame | None:
    """df with __cell and __width, the cell of a value whose key has more than least rows.

    Both are null for other keys, for rows that ``which`` leaves out and for keys whose
    rows are all alike in the column ``whole``.  None if there is no such key.
    """
    alike = F.min(whole) == F.max(whole) if whole else F.lit(False)
    counts = (
        df.where(which)
        .groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min(value).alias("lo"),
            F.max(value).alias("hi"),
            alike.alias("alike"),
        )
        .where("NOT alike")
    )
    # cells hold a quarter of the target where rows are spread evenly
    parts = F.ceil(4 * F.col("n") / target)
    step = F.ceil((F.col("hi") - F.col("lo") + 1) / parts).cast("long")
    cuts = counts.where((F.col("n") > least) & F.col("lo").isNotNull()).select(
        *_named(keys), F.col("lo").alias("__lo"), step.alias("__step")
    )
    if not cuts.count():
        return None
    df = _placed(df, written(cuts), keys, value, which)
    while True:
        held = df.where(F.col("__width") > 1).groupBy(*keys, "__cell", "__width").count()
        cuts = held.where(F.col("count") > target).select(
            *_named(keys),
            F.col("__cell").alias("__lo"),
            F.ceil(F.col("__width") / CUTS).cast("long").alias("__step"),
        )
        if not cuts.count():
            return df
        df = _placed(df, written(cuts), keys, value, F.col("__cell") == F.col("__lo"))


def _named(keys: list[str]) -> list[Column]:
    return [F.col(k).alias(f"__k{n}") for n, k in enumerate(keys)]


def _placed(
    df: DataFrame, cuts: DataFrame, keys: list[str], value: str, which: Column
) -> DataFrame:
    """Rows with the start and width of their cell, where their key or cell is cut."""
    on = which
    for n, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"__k{n}"))
    # whole-number division: a row must never be put into the next cell
    cell = F.expr(f"__lo + ({value} - __lo) div __step * __step")
    width = F.col("__step")
    if "__cell" in df.columns:
        cell, width = F.coalesce(cell, "__cell"), F.coalesce(width, "__width")
    kept = [c for c in df.columns if c not in ("__cell", "__width")]
    return df.join(cuts, on, "left").select(
        *kept, cell.alias("__cell"), width.alias("__width")
    )
