"""Ordered, keyed scans that survive hot keys.

``Timeline`` is the base of every stateful batch operator.  It offers

``scan``      previous / next row, last value seen so far, running maximum
``windows``   anchored windows: a row that finds no open window opens one that
              lasts until its own ``due`` time; rows at or before ``due`` belong
              to it; a reset row ends it early.

``windows`` is sequential by nature (where a window starts depends on where the
one before it ended), so it cannot be a Catalyst window function.  Spark shuffles
and sorts the rows, and each Arrow batch is labelled with array operations, stepping
only from one window to the next that opens, with constant memory.  For hot keys the same
labels come from chunks in parallel: each chunk is reduced to a transfer table (which
window is open at its end, for each window that may be open at its start).  Tables are
functions of that state, so neighbours combine into the table of both, in any grouping:
FAN of them at a time are combined in rounds, up to a table for the whole key, and the
state found at the start of each group is handed down again to its members.  No task ever
reads more than FAN tables of a key, and the state at each chunk start is joined back
before the labelling pass.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from alarmloom.operators.hotkeys import (
    CHUNK,
    DEFAULT_POLICY,
    SplitPolicy,
    split_hot_keys,
)
from alarmloom.storage import written

NONE = -(2**63)
FOREVER = 2**63 - 1

OPEN, PASS, RESET = 1, 0, -1


@dataclass(frozen=True)
class Scan:
    kind: str
    value: Column


def prev(value: Column) -> Scan:
    """Value on the row before this one."""
    return Scan("prev", value)


def nxt(value: Column) -> Scan:
    """Value on the row after this one."""
    return Scan("next", value)


def last_seen(value: Column) -> Scan:
    """Latest non-null value up to and including this row."""
    return Scan("last", value)


def running_max(value: Column) -> Scan:
    """Largest value up to and including this row."""
    return Scan("max", value)


class Timeline:
    """Rows of each key in (ts, tie) order; ``tie`` must make the order total.

    A row without a time has no place on a timeline and is left out.
    """

    def __init__(
        self,
        df: DataFrame,
        keys: Sequence[str],
        ts: str,
        tie: str,
        policy: SplitPolicy = DEFAULT_POLICY,
    ):
        self.columns = df.columns
        df = df.filter(F.col(ts).isNotNull())
        if not keys:
            df, keys = df.withColumn("__all", F.lit(0)), ["__all"]
        self.keys = list(keys)
        self.ts, self.tie, self.policy = ts, tie, policy
        self.placed = False
        self.df, self.split = split_hot_keys(df, self.keys, ts, tie, policy)
        self.part = self.keys + ([CHUNK] if self.split else [])
        self.order = [ts, tie]

    def with_columns(self, columns: dict[str, Column]) -> Timeline:
        """The same timeline with row-wise columns added; nothing is shuffled."""
        clone = object.__new__(Timeline)
        clone.__dict__.update(self.__dict__)
        clone.df = self.df.withColumns(columns)
        clone.columns = self.columns + [c for c in columns if c not in self.columns]
        return clone

    def filter(self, condition: Column) -> Timeline:
        """A subset of the rows, in the same order and chunks."""
        clone = self.with_columns({})
        clone.df = self.df.filter(condition)
        return clone

    def scanned(self, **scans: Scan) -> Timeline:
        """The timeline with one more column per scan, ready for another step."""
        clone = self.with_columns({})
        clone.df = self._scanned(scans)
        clone.placed = True
        clone.columns = self.columns + list(scans)
        return clone

    def rows(self) -> DataFrame:
        return self.df.select(*self.columns)

    # -- scans -------------------------------------------------------------

    def _over(self):
        return Window.partitionBy(*self.part).orderBy(*self.order)

    def _placed(self) -> DataFrame:
        """The rows shuffled by key (and chunk), once.

        The shuffle is explicit because a window alone would be content with rows
        that a join below left partitioned by a part of the key, such as the rule of
        (point, rule), or the key without its chunk: one hot value would then hold up
        a task although no key is hot.
        """
        return self.df if self.placed else self.df.repartition(*self.part)

    def _scanned(self, scans: dict[str, Scan]) -> DataFrame:
        w = self._over()
        so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        local = {}
        for name, s in scans.items():
            # The struct tells "no such row" (null) from "row with a null value".
            boxed = F.struct(s.value.alias("v"))
            if s.kind == "prev":
                local[name] = F.lag(boxed).over(w)
            elif s.kind == "next":
                local[name] = F.lead(boxed).over(w)
            elif s.kind == "last":
                seen = F.when(s.value.isNotNull(), boxed)
                local[name] = F.last(seen, ignorenulls=True).over(so_far)
            else:
                local[name] = F.struct(F.max(s.value).over(so_far).alias("v"))
        out = self._placed().withColumns(local)
        if self.split:
            out = self._carry_in(out, scans)
        return out.withColumns({n: F.col(n)["v"] for n in scans})

    def _carry_in(self, out: DataFrame, scans: dict[str, Scan]) -> DataFrame:
        """Complete chunk-local scans with what the neighbouring chunks hold."""
        at = F.struct(*self.order)
        summary = []
        for name, s in scans.items():
            boxed = F.struct(s.value.alias("v"))
            if s.kind == "prev":
                agg = F.max_by(boxed, at)
            elif s.kind == "next":
                agg = F.min_by(boxed, at)
            elif s.kind == "last":
                agg = F.max_by(boxed, F.when(s.value.isNotNull(), at))
            else:
                agg = F.struct(F.max(s.value).alias("v"))
            summary.append(agg.alias(name))
        chunks = (
            self.df.filter(F.col(CHUNK).isNotNull()).groupBy(*self.part).agg(*summary)
        )
        w = Window.partitionBy(*self.keys).orderBy(CHUNK)
        before = w.rowsBetween(Window.unboundedPreceding, -1)
        carry = {}
        for name, s in scans.items():
            if s.kind == "prev":
                carry[name] = F.lag(name).over(w)
            elif s.kind == "next":
                carry[name] = F.lead(name).over(w)
            elif s.kind == "last":
                carry[name] = F.last(name, ignorenulls=True).over(before)
            else:
                carry[name] = F.struct(F.max(F.col(name)["v"]).over(before).alias("v"))
        carried = chunks.select(
            *[F.col(k).alias(f"__j{i}") for i, k in enumerate(self.part)],
            *[c.alias(f"__in_{n}") for n, c in carry.items()],
        )
        joined = self._join_chunks(out, carried)
        merged = {}
        for name, s in scans.items():
            inner, outer = F.col(name), F.col(f"__in_{name}")
            if s.kind == "max":
                merged[name] = F.struct(F.greatest(inner["v"], outer["v"]).alias("v"))
            else:
                merged[name] = F.coalesce(inner, outer)
        return joined.withColumns(merged).drop(*[f"__in_{n}" for n in scans])

    def _join_chunks(self, rows: DataFrame, per_chunk: DataFrame) -> DataFrame:
        on = F.col(CHUNK) == F.col(f"__j{len(self.keys)}")
        for i, k in enumerate(self.keys):
            on = on & F.col(k).eqNullSafe(F.col(f"__j{i}"))
        return rows.join(per_chunk, on, "left").drop(
            *[f"__j{i}" for i in range(len(self.part))]
        )

    def scan(self, **scans: Scan) -> DataFrame:
        """The input rows plus one column per scan."""
        return self.scanned(**scans).rows()

    # -- anchored windows --------------------------------------------------

    def windows(self, kind: Column, due: Column) -> DataFrame:
        """The input rows plus labels (all times in epoch microseconds).

        kind   OPEN, PASS or RESET per row
        due    end of the window this row would open (OPEN rows)

        w_due    end of the window the row is in, null outside any
        w_open   time of the row that opened it
        w_pos    how many OPEN rows the window has had, this one included
        w_first  end of the first window since the last reset
        w_next   time of the key's next row

        A RESET row is labelled with the state it ends.
        """
        frame = self.with_columns(
            {
                "__ts": F.unix_micros(F.col(self.ts)),
                "__kind": kind.cast("int"),
                "__due": F.coalesce(due.cast("long"), F.lit(NONE)),
            }
        )
        w = frame._over()
        rows = frame._placed().withColumns(
            {"w_next": F.lead("__ts").over(w), "__first": F.row_number().over(w) == 1}
        )
        carried = list(_CARRY) if self.split else []
        if self.split:
            rows = self._join_chunks(rows, frame._chunk_states()).withColumns(
                {c: F.coalesce(F.col(c), F.lit(NONE)) for c in carried}
                | {"w_next": F.coalesce("w_next", "__next")}
            )
        # The sort is the one the window above already needed, so it costs nothing.
        rows = rows.select(
            *self.columns, "w_next", "__ts", "__kind", "__due", "__first",
            *carried, *[p for p in self.part if p not in self.columns],
        ).sortWithinPartitions(*self.part, *self.order)
        schema = T.StructType(
            [rows.schema[c] for c in [*self.columns, "w_next"]]
            + [
                T.StructField("w_due", T.LongType()),
                T.StructField("w_open", T.LongType()),
                T.StructField("w_pos", T.LongType()),
                T.StructField("w_first", T.LongType()),
            ]
        )
        keep = [*self.columns, "w_next"]
        return rows.mapInArrow(_labeller(keep, carried), schema)

    def _chunk_states(self) -> DataFrame:
        """The window state at the start of every chunk of every hot key."""
        hot = self.df.filter(F.col(CHUNK).isNotNull())
        width = hot.groupBy(*self.keys).agg(
            F.coalesce(
                F.max(F.when(F.col("__kind") == OPEN, F.col("__due") - F.col("__ts"))),
                F.lit(0),
            ).alias("__width")
        )
        width = width.select(
            *[F.col(k).alias(f"__w{i}") for i, k in enumerate(self.keys)], "__width"
        )
        on = F.lit(True)
        for i, k in enumerate(self.keys):
            on = on & F.col(k).eqNullSafe(F.col(f"__w{i}"))
        along = Window.partitionBy(*self.part).orderBy("__ts", "__tie")
        narrow = (
            hot.join(width, on, "left")
            .select(
                *self.part, "__ts", F.col(self.tie).alias("__tie"), "__kind", "__due",
                "__width",
            )
            .repartition(*self.part)
            .withColumn("__first", F.row_number().over(along) == 1)
            .sortWithinPartitions(*self.part, "__ts", "__tie")
        )
        key_fields = [self.df.schema[k] for k in self.part]
        tables = written(
            narrow.mapInArrow(
                _tables(self.part), T.StructType(key_fields + _TRANSFER_FIELDS)
            )
        )
        # only chunk labels and times are ordered per key, not tables
        along = Window.partitionBy(*self.keys).orderBy(CHUNK)
        whole = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        places = tables.select(*self.part, "first_ts").select(
            *[F.col(k).alias(f"__j{i}") for i, k in enumerate(self.part)],
            (F.row_number().over(along) - 1).cast("long").alias("__i"),
            (F.count(F.lit(1)).over(whole) - 1).alias("__last"),
            F.lead("first_ts").over(along).alias("__next"),
        )
        levels = [written(self._join_chunks(tables, places))]
        last = levels[0].agg(F.max("__last")).first()[0] or 0
        numbers = [T.StructField(c, T.LongType()) for c in ("__i", "__last")]
        while last >= FAN:
            # a key whose tables are one group needs no table of that group
            members = self._in_groups(levels[-1].where(F.col("__last") >= FAN))
            schema = T.StructType([*key_fields[:-1], *numbers, *_TRANSFER_FIELDS])
            levels.append(written(members.mapInArrow(_combined(self.keys, FAN), schema)))
            last //= FAN
        states = None
        for level in reversed(levels):
            # nothing is open before the first row of a key
            nothing = {c: F.lit(NONE) for c in _CARRY}
            if states is not None:
                level = self._join_groups(level, states)
                nothing = {c: F.coalesce(F.col(c), F.lit(NONE)) for c in _CARRY}
            members = self._in_groups(level.withColumns(nothing))
            kept = [c for c in (*self.part, "__i", "__next") if c in level.columns]
            schema = [level.schema[c] for c in kept]
            schema += [T.StructField(c, T.LongType()) for c in _CARRY]
            states = members.mapInArrow(_handed_down(kept, FAN), T.StructType(schema))
        return states.select(
            *[F.col(k).alias(f"__j{i}") for i, k in enumerate(self.part)],
            *_CARRY, "__next",
        )

    def _in_groups(self, tables: DataFrame) -> DataFrame:
        """Tables in order, FAN neighbours of a key (a group) in one partition."""
        grouped = [*self.keys, "__g"]
        members = tables.withColumn("__g", F.expr(f"__i div {FAN}"))
        return members.repartition(*grouped).sortWithinPartitions(*grouped, "__i")

    def _join_groups(self, members: DataFrame, states: DataFrame) -> DataFrame:
        """members with the state at the start of their group, where it is not the first."""
        starts = states.select(
            *[F.col(k).alias(f"__j{i}") for i, k in enumerate(self.keys)],
            F.col("__i").alias("__of"), *_CARRY,
        )
        on = F.expr(f"__i div {FAN}") == F.col("__of")
        for i, k in enumerate(self.keys):
            on = on & F.col(k).eqNullSafe(F.col(f"__j{i}"))
        return members.join(starts, on, "left").drop(
            "__of", *[f"__j{i}" for i in range(len(self.keys))]
        )


# -- inside tasks ------------------------------------------------------------

_CARRY = ("__in_due", "__in_open", "__in_pos", "__in_first")
FAN = 64

_LONGS = T.ArrayType(T.LongType())
_TRANSFER_FIELDS = [
    T.StructField("reset", T.BooleanType()),
    T.StructField("openers", T.LongType()),
    T.StructField("first_ts", T.LongType()),
    T.StructField("reach", T.LongType()),
    T.StructField("until", _LONGS),
    T.StructField("open", _LONGS),
    T.StructField("due", _LONGS),
    T.StructField("pos", _LONGS),
    T.StructField("first", T.LongType()),
]


def _labeller(keep: list[str], carried: list[str]):
    """Labels the sorted rows of a partition, batch by batch.

    ``state`` is the window that is open after the last row of a batch.
    """

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = (NONE, NONE, 0, NONE)
        for batch in batches:
            first, ts, kind, due, *carry = [
                batch.column(c).to_numpy(zero_copy_only=False)
                for c in ("__first", "__ts", "__kind", "__due", *carried)
            ]
            labels, state = label_rows(first, ts, kind, due, carry, state)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in keep]
                + [pa.array(x, mask=x == NONE) for x in labels],
                names=[*keep, "w_due", "w_open", "w_pos", "w_first"],
            )

    return label


State = tuple[int, int, int, int]


def label_rows(
    first: np.ndarray,
    ts: np.ndarray,
    kind: np.ndarray,
    due: np.ndarray,
    carry: list[np.ndarray],
    state: State,
) -> tuple[list[np.ndarray], State]:
    """Window labels (due, open, pos, first due) of sorted rows, and the state after.

    ``first`` marks the first row of a key or chunk; ``carry`` holds the state at those
    rows, ``state`` that at the first row if it goes on with the key before.  Where
    each window would end is found for all opening rows at once; only the chain from
    one window to the next that really opens is followed step by step.
    """
    n = len(ts)
    if not n:
        return [np.zeros(0, np.int64)] * 4, state
    rows = np.arange(n)
    heads = first.copy()
    heads[0] = True
    starts = np.flatnonzero(heads)
    segment = np.cumsum(heads) - 1
    ends = np.append(starts[1:], n)
    blank = np.full(len(starts), NONE)
    inward = [blank, blank, np.zeros(len(starts), np.int64), blank]
    if carry:
        inward = [np.asarray(c, np.int64)[starts] for c in carry]
    if not first[0]:
        inward = [np.array(x) for x in inward]
        for x, value in zip(inward, state):
            x[0] = value

    # windows that may open: one carried into a segment, then the opening rows
    opening = np.flatnonzero((kind == OPEN) & (due != NONE))
    open_at_start = np.flatnonzero(inward[0] != NONE)
    w_row = np.concatenate([starts[open_at_start], opening])
    w_due = np.concatenate([inward[0][open_at_start], due[opening]])
    w_open = np.concatenate([inward[1][open_at_start], ts[opening]])
    w_base = np.concatenate([inward[2][open_at_start], np.zeros(len(opening), np.int64)])
    fresh = np.concatenate([np.zeros(len(open_at_start), bool), np.ones(len(opening), bool)])
    w_segment = segment[w_row]

    # the row after each window: past its due time, or after a reset
    times, rank = np.unique(np.concatenate([ts, w_due]), return_inverse=True)
    wide = len(times) + 1
    w_end = np.searchsorted(
        segment * wide + rank[:n], w_segment * wide + rank[n:], side="right"
    )
    w_end = np.maximum(w_end, w_row + fresh)
    resets = np.append(np.flatnonzero(kind == RESET), n)
    reset = resets[np.searchsorted(resets, w_row)]
    w_end = np.minimum(np.minimum(w_end, reset + 1), ends[w_segment])

    some = np.flatnonzero(w_end > w_row)
    some = some[np.lexsort((fresh[some], w_row[some]))]
    follow = np.searchsorted(w_row[some], w_end[some]).tolist()
    chain, at = [], 0
    while at < len(follow):
        chain.append(at)
        at = follow[at]
    used = some[chain]

    # each row's window: the last one opened before it, if it has not ended
    owner = np.searchsorted(w_row[used], rows, side="right") - 1
    inside = owner >= 0
    if len(used):
        inside &= w_end[used][owner] > rows
    owned = used[owner[inside]]
    out_due, out_open, out_pos, out_first = (np.full(n, NONE) for _ in range(4))
    out_due[inside] = w_due[owned]
    out_open[inside] = w_open[owned]
    is_open = kind == OPEN
    opened = np.cumsum(is_open)
    out_pos[inside] = (
        w_base[owned] + opened[inside] - (opened - is_open)[w_row[owned]]
    )

    # the first window since a reset, by stretches of rows between resets
    turn = heads.copy()
    turn[1:] |= kind[:-1] == RESET
    stretch = np.cumsum(turn) - 1
    started = used[fresh[used]]
    where, at = np.unique(stretch[w_row[started]], return_index=True)
    first_row = np.full(stretch[-1] + 1, n)
    first_due = np.full(stretch[-1] + 1, NONE)
    first_row[where], first_due[where] = w_row[started][at], w_due[started][at]
    known = np.flatnonzero(inward[3] != NONE)
    first_row[stretch[starts[known]]] = starts[known]
    first_due[stretch[starts[known]]] = inward[3][known]
    seen = first_row[stretch] <= rows
    out_first[seen] = first_due[stretch][seen]

    after = (NONE, NONE, 0, NONE)
    if kind[-1] != RESET:
        held = [int(x[-1]) for x in (out_due, out_open, out_pos, out_first)]
        after = tuple(held) if held[0] != NONE else (NONE, NONE, 0, held[3])
    return [out_due, out_open, out_pos, out_first], after


def chunk_tables(
    starts: np.ndarray, ts: np.ndarray, kind: np.ndarray, due: np.ndarray, width: np.ndarray
) -> dict[str, np.ndarray]:
    """The tables of chunks: open window at a chunk's start -> at its end.

    The rows of each chunk are in order, ``starts`` are the first ones; all chunks are
    reduced at once.  Only OPEN rows start windows, so following the chain of windows
    needs only them.  ``until[e]`` is the last opener time of entry e: any window due before
    it (and not before the previous entry's) leads to the window (open, due, pos)
    [e] at the end of the chunk, or to none (due NONE).  A window due at or after
    the last ``until`` is still open at the end.  Windows due after ``reach`` cannot
    be open at the start.  Chains merge quickly on irregular data, so the entries are
    few; never are there more than windows that can be open at the end.

    The entries of all chunks are in one array per column, ``entries`` of them a chunk.
    """
    n, m = len(ts), len(starts)
    ends = np.append(starts[1:], n)
    chunk = np.repeat(np.arange(m), ends - starts)
    resets = np.concatenate([[-1], np.flatnonzero(kind == RESET)])
    last_reset = resets[np.searchsorted(resets, ends) - 1]
    reset = last_reset >= starts
    begin = np.where(reset, last_reset + 1, starts)

    openers = np.flatnonzero((kind == OPEN) & (np.arange(n) >= begin[chunk]))
    o_ts, o_due, o_chunk = ts[openers], due[openers], chunk[openers]
    k = np.bincount(o_chunk, minlength=m)
    o_end = np.cumsum(k)
    o_start = o_end - k
    # end[a]: the last window of the chain that starts at opener a
    each = np.arange(len(openers))
    times, rank = np.unique(np.concatenate([o_ts, o_due]), return_inverse=True)
    place = o_chunk * (len(times) + 1)
    follow = np.searchsorted(
        place + rank[:len(each)], place + rank[len(each):], side="right"
    )
    follow = np.maximum(follow, each + 1)
    end = np.where(follow < o_end[o_chunk], follow, each)
    while not np.array_equal(end, end[end]):
        end = end[end]

    # A window open at the start is due at most one width after it.
    first_ts = ts[starts]
    reach = first_ts + width[starts]
    reach[(width[starts] > 0) & (reach < first_ts)] = FOREVER
    near = np.bincount(o_chunk[o_ts <= reach[o_chunk]], minlength=m)
    used = np.where(reset, 0, np.minimum(k, near + 1))
    tails = np.flatnonzero(each - o_start[o_chunk] < used[o_chunk])
    changes = (np.diff(end[tails]) != 0) | (np.diff(o_chunk[tails]) != 0)
    tails = tails[np.append(changes, True)[:len(tails)]]
    # whatever was open before a reset is not any more
    cut = np.flatnonzero(reset)
    cut_last = end[o_start[cut[k[cut] > 0]]]
    cut_to = np.full((3, len(cut)), [[NONE], [NONE], [0]])
    cut_to[:, k[cut] > 0] = o_ts[cut_last], o_due[cut_last], o_end[o_chunk[cut_last]] - cut_last
    # windows due after the last opener, but before the last row
    last_opener = np.full(m, NONE)
    last_opener[k > 0] = o_ts[o_end[k > 0] - 1]
    none = np.flatnonzero(~reset & ((k == 0) | ((used == k) & (last_opener < ts[ends - 1]))))
    nothing = np.full(len(none), NONE)

    of = np.concatenate([o_chunk[tails], cut, none])
    order = np.argsort(of, kind="stable")
    last = end[tails]
    entries = {
        "until": [o_ts[tails], np.full(len(cut), FOREVER), ts[ends[none] - 1]],
        "open": [o_ts[last], cut_to[0], nothing],
        "due": [o_due[last], cut_to[1], nothing],
        "pos": [o_end[o_chunk[tails]] - last, cut_to[2], np.zeros(len(none), np.int64)],
    }
    first = np.full(m, NONE)
    first[k > 0] = o_due[o_start[k > 0]]
    return {
        "reset": reset, "openers": k, "first_ts": first_ts, "reach": reach, "first": first,
        "entries": np.bincount(of, minlength=m),
        **{c: np.concatenate(parts)[order] for c, parts in entries.items()},
    }


def _table_columns(found: dict[str, np.ndarray]) -> list[pa.Array]:
    """The columns of chunk_tables in the order of _TRANSFER_FIELDS."""
    offsets = pa.array(np.append(0, np.cumsum(found["entries"])), pa.int32())
    return [
        pa.ListArray.from_arrays(offsets, pa.array(found[f.name]))
        if f.dataType == _LONGS else pa.array(found[f.name])
        for f in _TRANSFER_FIELDS
    ]


_ROW_FIELDS = ("__ts", "__kind", "__due", "__width")


def _tables(part: list[str]):
    """Reduces the sorted chunks of a partition to their tables, a batch at a time.

    The rows of a chunk that has not ended are kept for the next batch.
    """
    names = [*part, *[f.name for f in _TRANSFER_FIELDS]]

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, held = None, []

        def reduced(heads: list[pa.RecordBatch], starts, pieces) -> pa.RecordBatch:
            rows = [np.concatenate(x) for x in zip(*pieces)]
            columns = _table_columns(chunk_tables(starts, *rows))
            labels = pa.Table.from_batches(heads).combine_chunks()
            labels = [pa.concat_arrays(labels.column(c).chunks) for c in part]
            return pa.RecordBatch.from_arrays(labels + columns, names=names)

        for batch in batches:
            rows = [
                batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64)
                for c in _ROW_FIELDS
            ]
            starts = np.flatnonzero(batch.column("__first").to_numpy(zero_copy_only=False))
            if not len(starts):
                held.append(rows)
                continue
            labels = batch.select(part).take(pa.array(starts))
            at, before = starts[-1], sum(len(x[0]) for x in held)
            ended = before + starts[:-1]
            if head is not None:
                ended = np.append(0, ended)
            if len(ended):
                heads = ([head] if head is not None else []) + [labels.slice(0, len(labels) - 1)]
                yield reduced(heads, ended, [*held, [x[:at] for x in rows]])
            head, held = labels.slice(len(labels) - 1), [[x[at:] for x in rows]]
        if head is not None:
            yield reduced([head], np.zeros(1, np.int64), held)

    return reduce


def _transfer(part: list[str]):
    """The table of one chunk of rows in any order."""

    def reduce(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["__ts", "__tie"])
        found = chunk_tables(
            np.zeros(1, np.int64), *[rows[c].to_numpy(dtype=np.int64) for c in _ROW_FIELDS]
        )
        columns = zip(_TRANSFER_FIELDS, _table_columns(found))
        record = {c: rows[c].iloc[0] for c in part}
        return pd.DataFrame([record | {f.name: c[0].as_py() for f, c in columns}])

    return reduce


def _through(table: dict, state: State, start: int = 0, end: int | None = None) -> State:
    """The state after a chunk, from the state before it and the chunk's table.

    The entries are those from ``start`` to ``end`` of the table's lists.
    """
    end = len(table["until"]) if end is None else end
    due, opened, pos, first = state
    if table["reset"]:
        due, opened, pos, first = NONE, NONE, 0, NONE
    e = bisect_right(table["until"], due, start, end)
    if e < end:
        due, opened, pos = (table[c][e] for c in ("due", "open", "pos"))
    else:
        pos += table["openers"]
    return due, opened, pos, table["first"] if first == NONE else first


def combine(a: dict, b: dict) -> dict:
    """The table of two neighbouring chunks, from theirs."""
    if b["reset"]:
        return {**b, "first_ts": a["first_ts"], "reach": a["reach"]}
    entries = [
        (until, _through(b, (due, opened, pos, NONE))[:3])
        for until, opened, due, pos in zip(a["until"], a["open"], a["due"], a["pos"])
    ]
    if not a["reset"]:  # windows that are still open after the first chunk
        entries += [
            (until, (due, opened, pos))
            for until, opened, due, pos in zip(b["until"], b["open"], b["due"], b["pos"])
            if until > a["until"][-1]
        ]
    kept: list[tuple[int, tuple]] = []
    for until, state in entries:
        if kept and kept[-1][1] == state:
            kept[-1] = (until, state)
        else:
            kept.append((until, state))
        if until > a["reach"]:
            break
    due, opened, pos = zip(*[state for _, state in kept])
    return {
        "reset": a["reset"], "openers": a["openers"] + b["openers"],
        "first_ts": a["first_ts"], "reach": a["reach"],
        "until": [until for until, _ in kept],
        "open": list(opened), "due": list(due), "pos": list(pos),
        "first": b["first"] if a["first"] == NONE else a["first"],
    }


def _combined(keys: list[str], fan: int):
    """Each group of neighbouring tables, sorted, to one."""
    names = [f.name for f in _TRANSFER_FIELDS]

    def records(groups: list[tuple[pa.RecordBatch, dict]]) -> Iterator[pa.RecordBatch]:
        if groups:
            heads = pa.Table.from_batches([head for head, _ in groups])
            columns = [pa.concat_arrays(c.chunks) for c in heads.columns]
            columns += [
                pa.array([whole[f.name] for _, whole in groups], to_arrow_type(f.dataType))
                for f in _TRANSFER_FIELDS
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[*keys, "__i", "__last", *names])

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, whole = None, None
        for batch in batches:
            ended = []
            places = batch.column("__i").to_pylist()
            # the place of a group among groups, and of the key's last group
            upper = [pa.array([i // fan for i in batch.column(c).to_pylist()], pa.int64())
                     for c in ("__i", "__last")]
            labels = pa.RecordBatch.from_arrays(
                [batch.column(c) for c in keys] + upper, names=[*keys, "__i", "__last"]
            )
            for row, table in enumerate(batch.select(names).to_pylist()):
                if places[row] % fan:
                    whole = combine(whole, table)
                    continue
                if head is not None:
                    ended.append((head, whole))
                head, whole = labels.slice(row, 1), table
            yield from records(ended)
        if head is not None:
            yield from records([(head, whole)])

    return reduce


def _handed_down(kept: list[str], fan: int):
    """The state at the start of each table, from that at the start of its group."""

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = (NONE, NONE, 0, NONE)
        for batch in batches:
            starts = zip(*[batch.column(c).to_pylist() for c in _CARRY])
            places = batch.column("__i").to_pylist()
            bounds = batch.column("until").offsets.to_pylist()
            single, table = ("reset", "openers", "first"), {}
            for c in ("until", "open", "due", "pos"):  # the lists of all tables
                table[c] = batch.column(c).values.to_numpy().tolist()
            scalars = zip(*[batch.column(c).to_pylist() for c in single])
            states = []
            for row, (start, values) in enumerate(zip(starts, scalars)):
                if places[row] % fan == 0:
                    state = start
                states.append(state)
                table.update(zip(single, values))
                state = _through(table, state, bounds[row], bounds[row + 1])
            carried = [pa.array(x, pa.int64()) for x in zip(*states)] or [
                pa.array([], pa.int64()) for _ in _CARRY
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in kept] + carried, names=[*kept, *_CARRY]
            )

    return follow
