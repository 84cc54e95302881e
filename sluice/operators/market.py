"""Candles, returns, volatility, and the as-of join."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.functions.typing import flag, seconds


def candles(trades: DataFrame, product: str, ts: str, price: str, tie: str, every: str = "hour") -> DataFrame:
    """Open, high, low, close, volume and count of every hour (or minute); the first and last trade by time and then id."""
    at = F.struct(ts, tie)
    rows = trades.groupBy(F.col(product).alias("product"), F.date_trunc(every, ts).cast("timestamp_ntz").alias("candle_start"))
    out = rows.agg(
        F.min_by(price, at).alias("open"),
        F.max(price).alias("high"),
        F.min(price).alias("low"),
        F.max_by(price, at).alias("close"),
        F.sum(price).alias("volume"),
        F.count("*").alias("n_trades"),
    )
    return out.withColumn("candle_end", (F.col("candle_start") + F.expr(f"interval 1 {every}")).cast("timestamp_ntz"))


def market_state(rows: DataFrame, short: int, long: int, span: int) -> DataFrame:
    """Per candle: log return, returns over two spans, volatility and volume over a third (both ends included)."""
    e = rows.withColumn("_e", seconds(F.col("candle_end")))
    line = Window.partitionBy("product").orderBy("_e")
    old = lambda n: F.last("close", True).over(line.rangeBetween(Window.unboundedPreceding, -n))
    step = e.withColumn("_previous", F.lag("close").over(line)).withColumn(
        "log_return",
        F.when((F.col("_previous") > 0) & (F.col("close") > 0), F.log(F.col("close") / F.col("_previous"))),
    )
    near = line.rangeBetween(-span, 0)
    change = lambda base: F.when(base > 0, F.col("close") / base - 1)
    out = step.select(
        "*",
        old(short).alias("_short"),
        old(long).alias("_long"),
        F.stddev_samp("log_return").over(near).alias("volatility"),
        F.sum("volume").over(near).alias("volume_sum"),
    )
    return out.select(
        *rows.columns,
        "log_return",
        change(F.col("_short")).alias("return_short"),
        change(F.col("_long")).alias("return_long"),
        "volatility",
        "volume_sum",
    )


def as_of(
    rows: DataFrame,
    states: DataFrame,
    key: str,
    ts: str,
    state_key: str,
    state_ts: str,
    values: list[str],
    required: bool = False,
) -> DataFrame:
    """Each row with the values of the newest state of its key at or before its time.

    Both sides in one frame, states first among equals, and the last state carried forward, all by key and hour: a key
    that most rows have is as many tasks as there are hours.  What an hour starts with comes from the hours' last states,
    a row a key and hour.  Null keys are a key like others.  required: a row without any state is an error.
    """
    left = rows.withColumn("_order", F.lit(1)).withColumn("_key", F.col(key)).withColumn("_at", F.col(ts))
    right = states.select(
        F.col(state_key).alias("_key"),
        F.col(state_ts).alias("_at"),
        F.lit(0).alias("_order"),
        F.struct(F.col(state_ts).alias("state_at"), *values).alias("_state"),
    )
    both = left.unionByName(right, allowMissingColumns=True).withColumn("_hour", F.date_trunc("hour", "_at"))
    line = Window.partitionBy("_key", "_hour").orderBy("_at", "_order").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    here = both.withColumn("_here", F.last("_state", True).over(line)).filter("_order = 1")
    ends = both.groupBy("_key", "_hour").agg(F.max_by("_state", F.when(F.col("_state").isNotNull(), F.col("_at"))).alias("_end"))
    earlier = Window.partitionBy("_key").orderBy("_hour").rowsBetween(Window.unboundedPreceding, -1)
    starts = ends.select(F.col("_key").alias("_k"), F.col("_hour").alias("_h"), F.last("_end", True).over(earlier).alias("_start"))
    joined = here.join(starts, F.col("_key").eqNullSafe(F.col("_k")) & F.col("_hour").eqNullSafe(F.col("_h")), "left")
    none = [F.raise_error(F.concat(
        F.lit("no state at or before "),
        F.col("_at").cast("string"),
    )).cast(here.schema["_here"].dataType)] if required else []
    carried = joined.withColumn("_found", F.coalesce("_here", "_start", *none))
    return carried.select(
        *rows.columns,
        F.col("_found.state_at").alias("state_at"),
        *(F.col(f"_found.{v}").alias(v) for v in values),
        (seconds(F.col(ts)) - seconds(F.col("_found.state_at"))).alias("freshness_seconds"),
        flag(F.col("_found").isNotNull()).alias("market_data_available"),
    )


def trade_rows(messages: DataFrame, value: str) -> DataFrame:
    """Trades of nested market messages (events[].trades[]): typed, positive, complete."""
    trade = "struct<trade_id:string,product_id:string,price:string,size:string,side:string,time:string>"
    parsed = messages.select(
        "*",
        F.from_json(
            F.col(value),
            f"struct<channel:string,timestamp:string,sequence_num:bigint,events:array<struct<type:string,trades:array<{trade}>>>>",
        ).alias("_m"),
    )
    each = parsed.select("_m", F.explode("_m.events").alias("_e")).select("_m", F.explode("_e.trades").alias("t"))
    out = each.select(
        F.col("t.trade_id").alias("trade_id"),
        F.col("t.product_id").alias("product_id"),
        F.expr("try_cast(t.price as decimal(20,8))").alias("price_usd"),
        F.expr("try_cast(t.size as decimal(20,8))").alias("size"),
        F.upper("t.side").alias("side"),
        F.expr("try_to_timestamp(t.time)").alias("trade_timestamp"),
        F.col("_m.sequence_num").alias("sequence_number"),
    )
    return out.filter("trade_id IS NOT NULL AND product_id IS NOT NULL AND price_usd > 0 AND size > 0 AND trade_timestamp IS NOT NULL")


def candle_rows(rows: DataFrame, array: str, product: str, start: int, end: int, arrival: str) -> DataFrame:
    """Candles of positional arrays [time, low, high, open, close, volume]: six long, in range, one a time (the last that came, by `arrival`)."""
    item = lambda i: F.col(array)[i]
    good = rows.filter((F.size(array) == 6) & (item(0) >= start) & (item(0) < end))
    own = good.select(
        F.col(product).alias("product_id"),
        F.timestamp_seconds(item(0).cast("long")).alias("candle_start"),
        *(item(i).cast("decimal(20,8)").alias(n) for i, n in ((3, "open"), (2, "high"), (1, "low"), (4, "close"), (5, "volume"))),
        F.col(arrival).alias("_row"),
    )
    w = Window.partitionBy("product_id", "candle_start").orderBy(F.col("_row").desc())
    return own.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n", "_row")


def request_windows(start: int, end: int, granularity: int = 60, most: int = 300) -> list[tuple[int, int]]:
    """[from, to) of each request that at most `most` candles answer."""
    step = granularity * most
    return [(a, min(a + step, end)) for a in range(start, end, step)]
