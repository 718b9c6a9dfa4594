"""Joining, merging, de-duplicating and matching streams.

Each function also takes plain tables; watermarks only bound stream state.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightwell.operators.relational import keep_first, union_all
from brightwell.operators.skew import attach


def with_watermark(df: DataFrame, ts: str, delay: str) -> DataFrame:
    """Watermark on a stream; a zone-less time column becomes a timestamp first."""
    if not df.isStreaming:
        return df
    if dict(df.dtypes)[ts] == "timestamp_ntz":
        df = df.withColumn(ts, F.col(ts).cast("timestamp"))
    return df.withWatermark(ts, delay)


def join_static(stream: DataFrame, table: DataFrame, on: str | Sequence[str], how: str = "left") -> DataFrame:
    """Look a stream up in a table. Spark broadcasts the table if its bytes allow it."""
    return stream.join(table, on, how)


def join_within(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str,
                within: str, delay: str = "10 minutes", how: str = "inner") -> DataFrame:
    """Rows of ``right`` that follow a row of ``left`` with the same key in time.

    The join key is (key, time bucket) with buckets as long as ``within``: a
    right row can only follow a left row of its own or of the previous bucket
    and is offered to both. A key with many rows is thereby cut along time
    instead of being paired row by row.

    Both sides get a watermark, so stream state older than the bound is dropped.
    The right columns come back as ``right_<name>``. ``how`` is inner, left_outer,
    right_outer or full_outer; on streams unmatched rows come once the watermark has
    passed. Of the side that is kept whole each row is in one bucket, as a copy that
    found no partner in the other bucket would be reported as unmatched: for
    right_outer it is the left rows that are offered twice. full_outer adds to the
    left outer join the right rows without a partner. On tables these need no second
    join of the rows: whether a partner exists follows from the first and the last
    time of the left rows in a bucket.
    """
    if how not in ("inner", "left_outer", "right_outer", "full_outer"):
        raise ValueError("how must be inner, left_outer, right_outer or full_outer")
    span = F.expr(f"INTERVAL {within}")
    start = F.lit("1970-01-01").cast("timestamp_ntz")
    seconds = F.unix_timestamp(start + span) - F.unix_timestamp(start)

    def bucket(ts):
        return F.floor(F.unix_timestamp(ts) / seconds)
    a = with_watermark(left, left_ts, delay)
    renamed = right.withColumnsRenamed({name: f"right_{name}" for name in right.columns})
    b = with_watermark(renamed, f"right_{right_ts}", delay)
    here, there = bucket(left_ts), bucket(f"right_{right_ts}")

    def joined(kind: str) -> DataFrame:
        twice = kind == "right_outer"
        x = a.withColumn("__bucket", F.explode(F.array(here, here + 1)) if twice else here).alias("a")
        y = b.withColumn("__right_bucket", there if twice else F.explode(F.array(there, there - 1))).alias("b")
        condition = (
            (F.col(f"a.{key}") == F.col(f"b.right_{key}"))
            & (F.col("a.__bucket") == F.col("b.__right_bucket"))
            & (F.col(f"b.right_{right_ts}") >= F.col(f"a.{left_ts}"))
            & (F.col(f"b.right_{right_ts}") <= F.col(f"a.{left_ts}") + span))
        return x.join(y, condition, kind).drop("__right_bucket")
    if how != "full_outer":
        return joined(how).drop("__bucket")
    whole = joined("left_outer").drop("__bucket")
    if left.isStreaming or right.isStreaming:
        alone = joined("right_outer").where(F.col("__bucket").isNull()).drop("__bucket")
    else:
        alone = _without_partner(a, b, key, left_ts, right_ts, here, there, span)
        alone = alone.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in a.schema], *b.columns)
    return whole.unionByName(alone)


def _without_partner(a: DataFrame, b: DataFrame, key: str, left_ts: str, right_ts: str, here: Column, there: Column, span: Column) -> DataFrame:
    """Right rows that follow no left row of their key in time. A bucket is as long as the
    bound: a left row of the same bucket is near enough if it is not later, one of the
    bucket before if it is late enough."""
    edges = a.groupBy(F.col(key).alias("__key"), here.alias("__at")).agg(F.min(left_ts).alias("__first"), F.max(left_ts).alias("__last"))
    edges = edges.where(F.col("__key").isNotNull() & F.col("__at").isNotNull())
    rows = b.withColumns({"__key": F.col(f"right_{key}"), "__at": there})
    rows = attach(rows, edges.select("__key", "__at", "__first"), ["__key", "__at"])
    rows = attach(rows, edges.select("__key", (F.col("__at") + 1).alias("__at"), "__last"), ["__key", "__at"])
    moment = F.col(f"right_{right_ts}")
    partner = (F.col("__first") <= moment) | (F.col("__last") >= moment - span)
    return rows.where(~F.coalesce(partner, F.lit(False))).select(*b.columns)


def unique_events(df: DataFrame, keys: Sequence[str], ts: str | None = None,
                  delay: str | None = None) -> DataFrame:
    """One row per key: on a table the smallest in time, then by the other columns;
    on a stream the first to arrive. With a time column and a delay, a stream keeps
    state only that long and finds copies that arrive within the delay."""
    if df.isStreaming and ts and delay:
        return with_watermark(df, ts, delay).dropDuplicatesWithinWatermark(list(keys))
    if df.isStreaming:
        return df.dropDuplicates(list(keys))
    rest = [c for c in df.columns if c not in keys]
    return keep_first(df, keys, list(dict.fromkeys([*([ts] if ts else []), *rest]))) if rest else df.distinct()


def merge(*streams: DataFrame, tag: str | None = None) -> DataFrame:
    """Union by column name; ``tag`` adds a column with the position of the input."""
    if tag:
        streams = [s.withColumn(tag, F.lit(i)) for i, s in enumerate(streams)]
    return union_all(*streams)


def session_windows(df: DataFrame, key: str, ts: str, gap: str = "30 minutes",
                    delay: str | None = None) -> DataFrame:
    """Sessions per key with the built-in session window (for streams; on big
    tables with hot keys use ``ordered.sessions``)."""
    if delay:
        df = with_watermark(df, ts, delay)
    return df.groupBy(F.session_window(ts, gap), key).agg(F.count(F.lit(1)).alias("n_events")).select(
        key, F.col("session_window.start").alias("session_start"),
        F.col("session_window.end").alias("session_end"), "n_events")


def match_sequence(df: DataFrame, key: str, ts: str, kind: str, first: str, then: str,
                   within: str, delay: str = "10 minutes") -> DataFrame:
    """Pairs of a ``first`` event and a later ``then`` event of the same key in time.

    A time-bounded self join: events may arrive in any order, and the watermark
    removes first events too old to find a partner. For "the very next event"
    on tables see ``ordered.followed_by``.
    """
    picked = df.select(key, ts, kind)
    return join_within(
        picked.where(F.col(kind) == first), picked.where(F.col(kind) == then),
        key, ts, ts, within, delay).select(
            F.col(f"a.{key}").alias(key), F.col(f"a.{ts}").alias("first_ts"),
            F.col(f"b.right_{ts}").alias("next_ts"))
