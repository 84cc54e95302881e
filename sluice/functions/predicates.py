"""Row predicates.  Each is a Column that is true or false, never null, unless said otherwise."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Fixed formats.
UUID_FORMAT = "^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[1-5][0-9a-fA-F]{3}-[89abAB][0-9a-fA-F]{3}-[0-9a-fA-F]{12}$"
COUNTRY_FORMAT = "^[A-Z]{2}$"
IP_FORMAT = r"^(([0-9]{1,3}\.){3}[0-9]{1,3}|[0-9A-Fa-f:]+)$"


def any_null(*columns: str) -> Column:
    """Some key column is null."""
    return reduce(lambda a, b: a | b, (F.col(c).isNull() for c in columns))


def all_present(*columns: str) -> Column:
    """No column is null."""
    return ~any_null(*columns)


def is_rescued(c: Column) -> Column:
    """Rescued data is there: neither null, blank nor an empty object."""
    return F.coalesce((F.trim(c) != "") & (F.trim(c) != "{}"), F.lit(False))


def bad_timestamp(rows: DataFrame, column: str) -> Column:
    """Null, not positive (numbers), or not readable (texts)."""
    kind, c = rows.schema[column].dataType, F.col(column)
    if isinstance(kind, T.StringType):
        return F.expr(f"try_to_timestamp(`{column}`)").isNull()
    if isinstance(kind, T.NumericType):
        return F.coalesce(c <= 0, F.lit(True))
    return c.isNull()


def missing(rows: DataFrame, column: str) -> Column:
    """Null, blank text or empty array."""
    kind, c = rows.schema[column].dataType, F.col(column)
    if isinstance(kind, T.StringType):
        return F.coalesce(F.trim(c) == "", F.lit(True))
    if isinstance(kind, T.ArrayType):
        return F.coalesce(F.size(c) == 0, F.lit(True)) | c.isNull()
    return c.isNull()


def malformed(c: Column, pattern: str) -> Column:
    """Present and not of a format."""
    return F.coalesce(~c.rlike(pattern), F.lit(False))


def not_one_of(c: Column, allowed: list) -> Column:
    """Present and not an allowed value."""
    return F.coalesce(~c.isin(*allowed), F.lit(False))


def some_not_of(c: Column, allowed: list) -> Column:
    """An array with a null or an unknown element."""
    return F.coalesce(F.exists(c, lambda x: x.isNull() | ~x.isin(*allowed)), F.lit(False))


def bad_size(c: Column, least: int, most: int) -> Column:
    """An array that is shorter or longer than allowed."""
    return F.coalesce((F.size(c) < least) | (F.size(c) > most), F.lit(False)) & c.isNotNull()


def repeats(c: Column) -> Column:
    """An array that holds a value twice."""
    return F.coalesce(F.size(F.array_distinct(c)) != F.size(c), F.lit(False))


def lost_in_conversion(raw: Column, typed: Column) -> Column:
    """A value that its type could not take."""
    return raw.isNotNull() & typed.isNull()


def date_differs(date: Column, ts: Column) -> Column:
    """A partition date that is not its timestamp's."""
    return F.coalesce(date != F.to_date(ts), F.lit(False))


def out_of_order(earlier: Column, later: Column) -> Column:
    """The first timestamp is after the second."""
    return F.coalesce(earlier > later, F.lit(False))


def not_finite(c: Column) -> Column:
    """NaN or infinite as a double."""
    d = c.cast("double")
    return F.coalesce(F.isnan(d) | (F.abs(d) == float("inf")), F.lit(False))


def supervised(label: Column, status: Column) -> Column:
    """A label that is known and final."""
    return label.isNotNull() & F.coalesce(status.isin("CONFIRMED_FRAUD", "CLEARED"), F.lit(False))


def is_alert(kind: Column, predicted: Column, probability: Column, score: Column, threshold: float, decision: str = "fraud_decision") -> Column:
    """A decision with the flag set whose probability, or else risk score, reaches the threshold; a missing flag is never one."""
    return F.coalesce((kind == decision) & predicted & (F.coalesce(probability, score) >= threshold), F.lit(False))


#: Fixed terms that a feature's name must not have.
LEAKING_TERMS = ("is_fraud", "target", "fraud_type", "fraud_label", "label_timestamp", "label_source", "investigation_status")
#: Columns that a live row must have to be learnt from.
LIVE_INPUTS = (
    "transaction_id",
    "account_id",
    "device_id",
    "event_timestamp",
    "asset",
    "transaction_type",
    "country",
    "transaction_amount_usd",
    "is_fraud",
)


def leaking_columns(columns: list[str], forbidden: tuple[str, ...] = LEAKING_TERMS) -> list[str]:
    """Names that hold a term of the future."""
    return sorted(c for c in columns if any(t in c.lower() for t in forbidden))


def is_indicator_name(name: str) -> bool:
    """Names of 0/1 features."""
    return name.startswith(("is_", "has_")) or name.endswith(("_flag", "_available", "_applicable")) or "mismatch" in name or "_flag_" in name
