"""Column functions: normalisation, epochs, hashes, calendars, fallbacks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def clean_string(c: Column, case: str | None = None) -> Column:
    """Trimmed, in upper or lower case if asked for; empty becomes null."""
    out = F.trim(c)
    out = {"upper": F.upper, "lower": F.lower}.get(case or "", lambda x: x)(out)
    return F.nullif(out, F.lit(""))


def clean_array(c: Column) -> Column:
    """Elements trimmed, in upper case."""
    return F.transform(c, lambda x: F.upper(F.trim(x)))


#: From which absolute value a number of epoch units is that unit, longest first.
EPOCH_UNITS = ((10**17, "ns"), (10**14, "us"), (10**11, "ms"), (0, "s"))


def epoch_unit(c: Column) -> Column:
    """ns, us, ms or s by magnitude; null for null."""
    size = F.abs(c.cast("decimal(38,0)"))
    out = F.when(c.isNull(), F.lit(None).cast("string"))
    for least, unit in EPOCH_UNITS:
        out = out.when(size >= F.lit(least), unit)
    return out


def epoch_to_timestamp(c: Column) -> Column:
    """A UTC timestamp from an epoch of any unit; nanoseconds are floored to microseconds."""
    unit, n = epoch_unit(c), c.cast("long")
    return F.when(
        unit == "ns",
        F.timestamp_micros(F.floor(n / F.lit(1000).cast("decimal(20,0)")).cast("long")),
    ).when(unit == "us", F.timestamp_micros(n)).when(unit == "ms", F.timestamp_millis(n)).when(unit == "s", F.timestamp_seconds(n))


def observed_unit(rows: DataFrame, column: str) -> DataFrame:
    """The unit that a column's largest magnitude tells."""
    return rows.agg(F.max(F.abs(F.col(column))).alias("_m")).select(F.col("_m").alias("largest"), epoch_unit(F.col("_m")).alias("unit"))


def micros(ts: Column) -> Column:
    """Microseconds since the epoch of any timestamp, zoned or not (UTC)."""
    return F.unix_micros(ts.cast("timestamp"))


def seconds(ts: Column) -> Column:
    """Whole seconds since the epoch, floored."""
    return F.unix_seconds(ts.cast("timestamp"))


def nanos(ts: Column) -> Column:
    """Nanoseconds as a decimal, for ordering columns of mixed resolution."""
    return (micros(ts).cast("decimal(38,0)") * 1000).cast("decimal(38,0)")


def event_time(*candidates: Column) -> Column:
    """The first time that is known, say of the prediction, the event, the broker and the ingestion."""
    return F.coalesce(*(c.cast("timestamp") for c in candidates))


def in_utc(ts: Column, zone: str) -> Column:
    """A local time of a zone as a timestamp in UTC."""
    return F.to_utc_timestamp(ts, zone)


def json_safe(c: Column) -> Column:
    """A number as JSON can hold it: null for NaN and infinities."""
    return finite_or_null(c)


def seconds_between(later: Column, earlier: Column) -> Column:
    """Difference of whole seconds."""
    return seconds(later) - seconds(earlier)


def row_hash(columns: list[str]) -> Column:
    """SHA-256 of the columns' texts, each behind its length, and - for a null: unlike rows never have the same text.  Timestamps keep microseconds."""

    def part(c: str) -> Column:
        text = F.col(c).cast("string")
        return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat_ws("|", *map(part, columns)), 256)


def payload_hash(c: Column) -> Column:
    """SHA-256 of a payload."""
    return F.sha2(c, 256)


def iso_weekday(ts: Column) -> Column:
    """1 for Monday to 7 for Sunday."""
    return F.pmod(F.dayofweek(ts) + 5, F.lit(7)) + 1


def flag(condition: Column) -> Column:
    """1 where a condition holds, 0 where not or unknown."""
    return F.when(condition, 1).otherwise(0).cast("int")


def mapped(c: Column, values: dict[str, str]) -> Column:
    """A value looked up in a literal map; null for others."""
    return F.create_map(*(F.lit(x) for kv in values.items() for x in kv))[c]


def first_present(*columns: Column) -> Column:
    """The first that is not null."""
    return F.coalesce(*columns)


def hour_of(ts: Column) -> Column:
    """Start of the hour, without a zone."""
    return F.date_trunc("hour", ts).cast("timestamp_ntz")


def minute_of(ts: Column) -> Column:
    """Start of the minute, without a zone."""
    return F.date_trunc("minute", ts).cast("timestamp_ntz")


def deterministic_id(*parts: Column) -> Column:
    """An id in the form of a UUID from the parts' hash."""
    h = F.sha2(F.concat_ws(":", *(p.cast("string") for p in parts)), 256)
    return F.concat_ws(
        "-",
        F.substring(h, 1, 8),
        F.substring(h, 9, 4),
        F.concat(F.lit("5"), F.substring(h, 14, 3)),
        F.concat(F.lit("8"), F.substring(h, 18, 3)),
        F.substring(h, 21, 12),
    )


#: The namespace of names that are URLs.
URL_NAMESPACE = "6ba7b8119dad11d180b400c04fd430c8"


def uuid5(name: Column, namespace: str = URL_NAMESPACE) -> Column:
    """The name-based UUID (version 5) of a name in a namespace (32 hex digits)."""
    h = F.substring(F.sha1(F.concat(F.unhex(F.lit(namespace)), F.encode(name, "UTF-8"))), 1, 32)
    variant = F.lower(F.hex(F.conv(F.substring(h, 17, 1), 16, 10).cast("int").bitwiseAND(3).bitwiseOR(8)))
    return F.concat_ws(
        "-",
        F.substring(h, 1, 8),
        F.substring(h, 9, 4),
        F.concat(F.lit("5"), F.substring(h, 14, 3)),
        F.concat(variant, F.substring(h, 18, 3)),
        F.substring(h, 21, 12),
    )


def model_columns(categorical: list[str], numeric: list[str]) -> list[Column]:
    """Features in a model's types."""
    return [F.col(c).cast("string").alias(c) for c in categorical] + [F.col(c).cast("double").alias(c) for c in numeric]


def as_bool(c: Column) -> Column:
    """true, 1 and yes in any case are true; other texts false; null stays null."""
    return F.lower(F.trim(c.cast("string"))).isin("true", "1", "yes")


def normal_target(c: Column) -> Column:
    """1 for true or 1, 0 for false or 0, null for anything else."""
    text = F.lower(F.trim(c.cast("string")))
    return F.when(text.isin("true", "1"), 1).when(text.isin("false", "0"), 0).cast("int")


def model_type_fits(dtype: str, categorical: bool) -> bool:
    """Whether a column's type will do as a model input: text for categories, any number otherwise."""
    return dtype == "string" if categorical else dtype in ("tinyint", "smallint", "int", "bigint", "float", "double") or dtype.startswith("decimal")


def finite_or_null(c: Column) -> Column:
    """A double without NaN and infinities, for deviations that ignore them."""
    d = c.cast("double")
    return F.when(~(F.isnan(d) | (F.abs(d) == float("inf"))), d)
