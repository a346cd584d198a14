"""Gap-based sessionization and the six per-click session features.

Definitions (per key, clicks in time order, ``ts`` = whole seconds since the
frame's first click, floored):

* ``click_timestamp``                   floor((epoch_ms - min epoch_ms) / 1000)
* ``previous_sessions``                 number of gaps >= ``gap`` seen so far (0-based session id)
* ``total_sessions``                    max(previous_sessions) over the key + 1
* ``current_session_duration_till_now`` ts - first ts of the session
* ``current_session_duration``          last ts - first ts of the session
* ``avg_previous_sessions_duration``    mean duration of the key's earlier sessions, -1.0 for the first

Execution plan (why it looks the way it does)
--------------------------------------------
A per-key window over raw clicks puts every click of a key into one task; one
hot key can hold a third of all rows. Instead, clicks are bucketed into chunks
``(key, ts div gap)``. Two clicks in one chunk are less than ``gap`` apart, so a
session boundary can only fall *between* chunks: every session is a run of
consecutive chunks. So

1. clicks -> chunk table ``(key, chunk, first, last, n)`` by a hash aggregate
   (map-side partial aggregation: a hot key or hot chunk is pre-reduced before
   the shuffle);
2. boundaries, session ids, starts, ends and running sums are windows over the
   chunk table, whose size per key is bounded by time span / gap, not by the
   number of clicks;
3. the per-chunk results join back to the clicks on ``(key, chunk)``; AQE
   broadcasts the chunk side when its measured size is under the broadcast
   threshold, and otherwise splits skewed click partitions (skew join).

Nothing here depends on physical row order, so unsorted input is fine.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gapwise.functions.scalars import epoch_millis, floor_div, safe_div
from gapwise.runtime import drop_scratch, materialize

DEFAULT_GAP = 15 * 60  # seconds; a gap of exactly this long starts a new session

FEATURES = [
    "click_timestamp",
    "previous_sessions",
    "total_sessions",
    "current_session_duration_till_now",
    "current_session_duration",
    "avg_previous_sessions_duration",
]


def _own_name() -> str:
    """A column name that no input has."""
    return f"x{uuid.uuid4().hex}"


def _check_gap(gap: int) -> int:
    gap = int(gap)
    if gap <= 0:
        raise ValueError("gap must be a positive number of seconds")
    return gap


def add_click_timestamp(df: DataFrame, time_col: str = "click_time", out: str = "click_timestamp",
                        epoch=None) -> DataFrame:
    """Seconds since the frame's earliest click (or since ``epoch``), floored.

    The frame minimum is a scalar subquery: one tiny aggregate job whose value
    is inlined into the projection (no join, no driver round trip).
    """
    ms = epoch_millis(time_col)
    if epoch is None:
        origin = df.agg(F.min(ms)).scalar()
    else:
        origin = epoch_millis(F.lit(epoch).cast("timestamp_ntz"))
    return df.withColumn(out, floor_div(ms - origin, 1000))


def session_chunks(df: DataFrame, gap: int = DEFAULT_GAP, key: str = "ip", ts: str = "click_timestamp",
                   label: str | None = None, time_col: str | None = None) -> DataFrame:
    """Chunk table: one row per (key, ts div gap) with first/last second and click count.

    Optionally also the label count (``_pos``) and the raw first/last click
    time (``_tmin``/``_tmax``), for reports that never need per-click rows.
    """
    gap = _check_gap(gap)
    aggs = [F.min(ts).alias("_first"), F.max(ts).alias("_last"), F.count(F.lit(1)).alias("_n")]
    if label is not None:
        aggs.append(F.count_if(F.col(label)).alias("_pos"))
    if time_col is not None:
        aggs += [F.min(time_col).alias("_tmin"), F.max(time_col).alias("_tmax")]
    return df.groupBy(F.col(key), floor_div(F.col(ts), gap).alias("_chunk")).agg(*aggs)


def stitch_chunks(chunks: DataFrame, gap: int = DEFAULT_GAP, key: str = "ip") -> DataFrame:
    """Per chunk: session id, session start/end, total sessions, mean of earlier session lengths.

    Windows only touch the chunk table (bounded per key by span / gap).
    """
    gap = _check_gap(gap)
    w = Window.partitionBy(key).orderBy("_chunk")
    prev_last = F.lag("_last").over(w)
    c = (chunks
         .withColumn("_new", F.coalesce((F.col("_first") - prev_last) >= gap, F.lit(False)))
         .withColumn("_opens", F.col("_new") | prev_last.isNull()))
    c = (c.withColumn("previous_sessions", F.sum(F.col("_new").cast("long")).over(w))
          .withColumn("session_start", F.max(F.when(F.col("_opens"), F.col("_first"))).over(w)))
    c = c.withColumn("session_end", F.max("_last").over(Window.partitionBy(key, "previous_sessions")))
    dur = F.col("session_end") - F.col("session_start")
    c = c.withColumn("current_session_duration", dur)
    # Each chunk that opens a new session contributes the length of the session
    # that just closed; the running sum is the total length of earlier sessions.
    closed = F.when(F.col("_new"), F.lag("current_session_duration").over(w))
    c = c.withColumn("_prev_total", F.sum(closed).over(w))
    return (c.withColumn("total_sessions", F.max("previous_sessions").over(Window.partitionBy(key)) + 1)
             .withColumn("avg_previous_sessions_duration",
                         F.coalesce(safe_div("_prev_total", "previous_sessions"), F.lit(-1.0))))


def session_features(df: DataFrame, gap: int = DEFAULT_GAP, key: str = "ip", time_col: str = "click_time",
                     epoch=None) -> DataFrame:
    """Input columns + the six session features (``df.transform(session_features)``)."""
    gap = _check_gap(gap)
    rows = add_click_timestamp(df, time_col, epoch=epoch)
    return _with_chunks(df, rows, stitch_chunks(session_chunks(rows, gap, key), gap, key), gap, key)


def _with_chunks(df: DataFrame, rows: DataFrame, chunks: DataFrame, gap: int, key: str) -> DataFrame:
    """Columns of ``df`` (those called like a feature are replaced) and the features, from a stitched chunk table.

    Null-safe keys: a click with a null key or time (a contract violation) still
    comes out, with the features of its own null group.
    """
    k, c, at = _own_name(), _own_name(), _own_name()
    wanted = ["previous_sessions", "total_sessions", "session_start", "current_session_duration", "avg_previous_sessions_duration"]
    info = chunks.select(F.col(key).alias(k), F.col("_chunk").alias(c), *[F.col(x).alias(k + x) for x in wanted])
    out = rows.withColumn(at, floor_div(F.col("click_timestamp"), gap)).join(
        info, F.col(key).eqNullSafe(F.col(k)) & F.col(at).eqNullSafe(F.col(c)), "inner")

    def of(name: str) -> Column:
        return F.col(k + name).alias(name)
    till = (F.col("click_timestamp") - F.col(k + "session_start")).alias("current_session_duration_till_now")
    return out.select(*[F.col(x) for x in df.columns if x not in FEATURES], "click_timestamp", of("previous_sessions"), of("total_sessions"),
                      till, of("current_session_duration"), of("avg_previous_sessions_duration"))


def session_table(df: DataFrame, gap: int = DEFAULT_GAP, key: str = "ip", time_col: str = "click_time",
                  label: str | None = None, epoch=None) -> DataFrame:
    """One row per (key, session): start/end second, clicks, duration, label count, running stats.

    Sessions per key are bounded by (time span / gap) + 1, so this table stays
    small even when one key owns a large share of the clicks.
    """
    rows = add_click_timestamp(df, time_col, epoch=epoch)
    return table_of_chunks(stitch_chunks(session_chunks(rows, gap, key, label=label), gap, key), key)


def table_of_chunks(st: DataFrame, key: str = "ip") -> DataFrame:
    """The session table of a stitched chunk table."""
    aggs = [F.min("session_start").alias("session_start"), F.max("_last").alias("session_end"),
            F.sum("_n").alias("n_clicks"), F.max("current_session_duration").alias("current_session_duration"),
            F.max("total_sessions").alias("total_sessions"),
            F.max("avg_previous_sessions_duration").alias("avg_previous_sessions_duration")]
    if "_pos" in st.columns:
        aggs.append(F.sum("_pos").alias("n_attributed"))
    return st.groupBy(key, "previous_sessions").agg(*aggs)


@dataclass
class Sessions:
    """Clicks and their stitched chunk table, which is built and written once for all that is asked of it."""

    clicks: DataFrame
    rows: DataFrame
    chunks: DataFrame
    folder: str
    gap: int
    key: str

    def features(self) -> DataFrame:
        """Input columns + the six session features."""
        return _with_chunks(self.clicks, self.rows, self.chunks, self.gap, self.key)

    def table(self) -> DataFrame:
        """One row per (key, session)."""
        return table_of_chunks(self.chunks, self.key)

    def with_means(self) -> DataFrame:
        """Input columns + the features, the mean of earlier sessions looked up in the session table.

        The lookup happens chunk by chunk; clicks are joined once.
        """
        return _with_chunks(self.clicks, self.rows, join_session_means(self.chunks, self.table(), self.key), self.gap, self.key)

    def release(self) -> None:
        drop_scratch(self.clicks.sparkSession, self.folder)


def sessionize(df: DataFrame, gap: int = DEFAULT_GAP, key: str = "ip", time_col: str = "click_time", label: str | None = None,
               epoch=None) -> Sessions:
    """Build the chunk table of ``df`` once; features, session table and session means are read off it."""
    rows = add_click_timestamp(df, time_col, epoch=epoch)
    chunks, folder = materialize(stitch_chunks(session_chunks(rows, gap, key, label=label), gap, key), "chunks")
    return Sessions(df, rows, chunks, folder, gap, key)


def merge_chunks(*tables: DataFrame, key: str = "ip") -> DataFrame:
    """The chunk table of all clicks from chunk tables of parts of them (same gap and epoch), however the parts were cut."""
    both = tables[0]
    for more in tables[1:]:
        both = both.unionByName(more)
    least = [F.min(c).alias(c) for c in ("_first", "_tmin") if c in both.columns]
    most = [F.max(c).alias(c) for c in ("_last", "_tmax") if c in both.columns]
    return both.groupBy(key, "_chunk").agg(*least, *most, *[F.sum(c).cast("long").alias(c) for c in ("_n", "_pos") if c in both.columns])


def append_clicks(store: DataFrame, clicks: DataFrame, epoch, gap: int = DEFAULT_GAP, key: str = "ip", time_col: str = "click_time",
                  label: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(stitched chunk table with the new clicks in it, features of the new clicks).

    ``store`` is the stitched chunk table of the clicks so far, with the same gap,
    label and fixed ``epoch``. Only chunks of keys with new clicks are merged and
    stitched again; earlier clicks are not read. The new clicks' features are those
    of the whole log. Clicks may be late: they need not come after those so far.
    """
    rows = add_click_timestamp(clicks, time_col, epoch=epoch)
    new = session_chunks(rows, gap, key, label=label)
    k = _own_name()
    same = F.col(key).eqNullSafe(F.col(k))
    touched = clicks.select(F.col(key).alias(k)).distinct()
    again = stitch_chunks(merge_chunks(store.join(touched, same, "left_semi").select(*new.columns), new, key=key), gap, key)
    whole = store.join(touched, same, "left_anti").unionByName(again)
    return whole, _with_chunks(clicks, rows, again, gap, key)


GAP_BLOCK_SECONDS = 3600  # block width of the two-level previous-second lookup


def key_summary(df: DataFrame, gap: int = DEFAULT_GAP, key: str = "ip", time_col: str = "click_time",
                label: str = "is_attributed", epoch=None) -> DataFrame:
    """One row per key: total_sessions, n_clicks, label counts (true/false), first and last click.

    Built from the stitched chunk table alone: per-key reports never join
    back to (or shuffle) the raw clicks.
    """
    rows = add_click_timestamp(df, time_col, epoch=epoch)
    st = stitch_chunks(session_chunks(rows, gap, key, label=label, time_col=time_col), gap, key)
    return st.groupBy(key).agg(
        F.max("total_sessions").alias("total_sessions"),
        F.sum("_n").cast("long").alias("n_clicks"),
        F.sum("_pos").cast("long").alias("true"),
        (F.sum("_n") - F.sum("_pos")).cast("long").alias("false"),
        F.min("_tmin").alias("min_date"),
        F.max("_tmax").alias("max_date"))


def gap_to_previous(df: DataFrame, key: str = "ip", ts: str = "click_timestamp",
                    order: tuple[str, ...] | None = None, out: str = "gap_seconds") -> DataFrame:
    """Seconds since the previous click of the same key (0 for the key's first click).

    Of the clicks of a key that share a second exactly one, the earliest by
    ``order``, carries the gap to the previous occupied second; the others have
    0. ``order`` defaults to (click_time, click_id); without a ``click_id``, to
    all columns and then a row number, given once and written with the rows, so
    that equal rows are told apart too. The previous second is found in two
    levels so no window holds more than one block of one key: inside ``(key,
    hour block)`` by ``lag`` (≤ 3,600 rows), and for a block's first second from
    the previous block's last second, a window over the per-block table
    (≤ span / 3,600 rows per key).
    """
    cols = df.columns
    if order is None:
        order = ("click_time", "click_id")
        if "click_id" not in cols:
            row = _own_name()
            order = (*cols, row)
            df, _ = materialize(df.withColumn(row, F.monotonically_increasing_id()), "gap-rows")
    k = _own_name()
    first = F.struct(*[F.col(c) for c in order])
    block = floor_div(F.col(ts), GAP_BLOCK_SECONDS)
    secs = df.groupBy(F.col(key), F.col(ts)).agg(F.min(first).alias("_first_key")).withColumn("_b", block)
    prev_in_block = F.lag(ts).over(Window.partitionBy(key, "_b").orderBy(ts))
    blocks = secs.groupBy(key, "_b").agg(F.max(ts).alias("_block_last"))
    blocks = blocks.withColumn("_prev_block_last", F.lag("_block_last").over(Window.partitionBy(key).orderBy("_b")))
    blocks = blocks.select(F.col(key).alias("_bk"), F.col("_b").alias("_bb"), "_prev_block_last")
    secs = (secs.withColumn("_prev", prev_in_block)
                .join(blocks, F.col(key).eqNullSafe(F.col("_bk")) & F.col("_b").eqNullSafe(F.col("_bb")), "inner")
                .select(F.col(key).alias(k), F.col(ts).alias(k + "t"), F.col("_first_key").alias(k + "first"),
                        F.coalesce(F.col(ts) - F.coalesce("_prev", "_prev_block_last"),
                                   F.lit(0).cast("long")).alias(k + "gap")))
    joined = df.join(secs, F.col(key).eqNullSafe(F.col(k)) & F.col(ts).eqNullSafe(F.col(k + "t")), "inner")
    return joined.select(*[F.col(c) for c in cols],
                         F.when(first.eqNullSafe(F.col(k + "first")), F.col(k + "gap")).otherwise(F.lit(0).cast("long")).alias(out))


def join_session_means(clicks: DataFrame, table: DataFrame, key: str = "ip", session: str = "previous_sessions",
                       out: str = "avg_previous_sessions_duration") -> DataFrame:
    """Clicks with the mean length of their key's earlier sessions, looked up in :func:`session_table`."""
    k = _own_name()
    means = table.select(F.col(key).alias(k), F.col(session).alias(k + "s"), out)
    return (clicks.drop(out).join(means, F.col(key).eqNullSafe(F.col(k)) & (F.col(session) == F.col(k + "s")), "left")
            .drop(k, k + "s"))
