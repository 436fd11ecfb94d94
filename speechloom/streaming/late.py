"""Gap sessions of a stream whose rows come late: rows wait in state for the watermark, event-time timers release them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

#: In place of a null: the time of a row or of a key none of whose rows was numbered, or what ties are ordered by.
NEVER = -(1 << 63)


def reordered(names: list[str], tolerance: float, forget_ms: int | None, dealt: bool) -> Callable[[tuple, Iterator, GroupState], Iterator]:
    """What a batch does with a group, which is a key, or where `dealt` is set a bucket of keys: its rows wait, those that the
    watermark has passed are numbered in order.

    State: the waiting rows as five arrays, their keys by number; the keys (of a bucket), and for each the time, end and segment of
    the last row that was numbered. The timer is set at the earliest waiting row, or where it comes before that, at the time
    when a key without waiting rows is forgotten. Rows up to the watermark are dropped from the next batch on, so none can come
    between rows that are numbered already.
    """
    import numpy as np
    import pandas as pd

    kinds = (np.int64, np.int64, np.int64, np.float64, np.float64)

    def numbered(owner, at, begin, end, last):
        """Segments of rows in the order of key and time; `last` has the keys' last time, end and segment, which become those after the rows."""
        first, final = np.ones(len(owner), bool), np.ones(len(owner), bool)
        first[1:] = final[:-1] = owner[1:] != owner[:-1]
        before, close = (np.where(first, known[owner], np.roll(x, 1)) for known, x in zip(last[:2], (at, end), strict=True))
        anew = (before != NEVER) & (at - before > forget_ms * 1000) if forget_ms is not None else np.zeros(len(owner), bool)
        with np.errstate(invalid="ignore"):
            gap = (np.abs(begin - close) > tolerance) & ~anew
        gaps, starts = np.cumsum(gap), np.flatnonzero(first | anew)
        base = np.where(anew, 0, last[2][owner])[starts] - (gaps - gap)[starts]
        segment = gaps + np.repeat(base, np.diff(np.append(starts, len(owner))))
        for known, x in zip(last, (at, end, segment), strict=True):
            known[owner[final]] = x[final]
        return segment

    def step(group: tuple, frames: Iterator, state: GroupState) -> Iterator:
        *waiting, keys, at, end, segment = state.get if state.exists else [[] for _ in range(9)]
        rows = [np.array(x, k) for x, k in zip(waiting, kinds, strict=True)]
        came = None if state.hasTimedOut else pd.concat(list(frames))
        if not dealt or pd.isna(group[0]):  # null has a bucket of its own
            keys, owner = [None if dealt else group[0]], np.zeros(0 if came is None else len(came), np.int64)
        elif came is not None:
            # by place, as Spark renames columns that aren't identifiers: ..., key, time, at, tie, begin, end
            codes, every = pd.factorize(pd.Series([*keys, *came.iloc[:, -6].tolist()], dtype=object), use_na_sentinel=False)
            owner, keys = codes[len(keys) :], list(every)
        if came is not None:
            rows = [np.concatenate([x, y.astype(k)]) for x, y, k in zip(rows, [owner, *(came.iloc[:, k].to_numpy() for k in range(-4, 0))], kinds, strict=True)]
        fresh = len(keys) - len(at)
        last = [np.array([*x, *[y] * fresh], k) for x, y, k in ((at, NEVER, np.int64), (end, np.nan, np.float64), (segment, 0, np.int64))]
        watermark = state.getCurrentWatermarkMs()
        timeless, later = rows[1] == NEVER, rows[1] > watermark * 1000
        ready = np.flatnonzero(~timeless & ~later)
        ready = ready[np.lexsort((rows[2][ready], rows[1][ready], rows[0][ready]))]
        segments = numbered(*(rows[k][ready] for k in (0, 1, 3, 4)), last)

        over = None if forget_ms is None else -(-last[0] // 1000) + forget_ms
        waits = np.bincount(rows[0][later], minlength=len(keys)) > 0
        stays = waits | ((last[0] != NEVER) & (True if over is None else over > watermark))
        if not stays.any():
            if state.exists:
                state.remove()
        else:
            place = np.cumsum(stays) - 1
            left = [place[rows[0][later]], *(x[later] for x in rows[1:])]
            state.update((*(x.tolist() for x in left), [k for k, s in zip(keys, stays, strict=True) if s] if dealt else [], *(x[stays].tolist() for x in last)))
            timers = [] if over is None else over[stays & ~waits].tolist()
            if later.any():
                timers.append(-(-int(left[1].min()) // 1000))
            if timers:
                state.setTimeoutTimestamp(min(timers))
        if len(ready) or timeless.any():
            shown = np.concatenate([np.flatnonzero(timeless), ready])
            columns = [pd.Series([keys[k] for k in rows[0][shown].tolist()], dtype=object), pd.arrays.IntegerArray(rows[2][shown], rows[2][shown] == NEVER), *(x[shown] for x in rows[3:])]
            out = pd.DataFrame(dict(zip(names, columns, strict=True)))
            out["segment_index"] = pd.array([None] * int(timeless.sum()) + segments.tolist(), "Int32")
            yield out

    return step


def late_sessions(stream: DataFrame, key: str, time: str, tie: str, begin: str, end: str, tolerance: float = 0.2, delay: str = "1 hour", forget_ms: int | None = None, buckets: int | None = None) -> DataFrame:
    """(key, tie, begin, end, segment_index) of a stream, in append mode: the batch's gap sessions, for rows in any order
    within `delay` of the latest time seen.

    `time` is a timestamp, in the order of `begin` within a key; rows of one time are ordered by `tie`, a whole number, null
    first. A row later than the watermark is dropped by Spark, which counts it in the progress as numRowsDroppedByWatermark. A row
    without time has no place in the order: it comes at once, with a null segment. A null begin or end counts as no gap, as
    in the batch. A task holds the rows of one group that came within the delay; any state store does.

    forget_ms: a key without rows for longer than that, in event time, begins at segment 0 again, and a timer drops its state;
    so what comes out doesn't depend on how rows fall into batches. Without it, a key keeps its last end and number for ever.

    buckets: a group, with its state and timer, is one key; every batch calls Python for each key that has rows or is due, some
    milliseconds a call. Where a batch brings many keys with few rows each, `buckets` deals the keys by a hash into so many
    groups, numbered at once. A batch then writes all of a bucket's state anew, and a task holds a bucket's rows, so there
    should be a few hundred keys in each. The number is the checkpoint's for ever. Keys are strings or whole numbers then.
    """
    kind = {f.name: f.dataType for f in stream.schema}
    if buckets is not None and not isinstance(kind[key], (T.StringType, T.IntegralType)):
        raise TypeError(f"keys of type {kind[key].simpleString()} can't be dealt into buckets")
    told = stream.withWatermark(time, delay)
    told = told.select(key, time, F.coalesce(F.unix_micros(time), F.lit(NEVER)).alias("_at"), F.coalesce(F.col(tie).cast("long"), F.lit(NEVER)).alias(tie), F.col(begin).cast("double").alias(begin), F.col(end).cast("double").alias(end))
    if buckets is not None:  # null stays apart: among whole numbers it would make them floating
        told = told.select(F.when(F.col(key).isNotNull(), F.pmod(F.xxhash64(key), F.lit(buckets))).alias("_bucket"), *told.columns)
    out = T.StructType([T.StructField(key, kind[key]), T.StructField(tie, kind[tie]), T.StructField(begin, T.DoubleType()), T.StructField(end, T.DoubleType()), T.StructField("segment_index", T.IntegerType())])
    state = f"owners array<long>, ats array<long>, ties array<long>, begins array<double>, ends array<double>, keys array<{kind[key].simpleString()}>, at array<long>, last array<double>, segment array<long>"
    step = reordered([key, tie, begin, end], tolerance, forget_ms, buckets is not None)
    return told.groupBy(key if buckets is None else "_bucket").applyInPandasWithState(step, out, state, "append", GroupStateTimeout.EventTimeTimeout)
