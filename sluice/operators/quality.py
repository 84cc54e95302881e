"""Data quality: rules as data, one array of failed reasons a row, and reports.

A rule is a name and a condition that is true for a bad row.  All rules of a
table become a single array expression, so a row is looked at once however
many rules there are.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions import predicates as P

REASONS = "_reasons"


@dataclass(frozen=True)
class Rule:
    """A name and the condition of a bad row."""

    name: str
    condition: Column


@dataclass
class TableRules:
    """What a table's columns must be like; generic rules follow from it."""

    required: tuple[str, ...] = ()
    uuids: tuple[str, ...] = ()
    countries: tuple[str, ...] = ()
    addresses: tuple[str, ...] = ()
    allowed: dict[str, list] | None = None
    allowed_elements: dict[str, list] | None = None
    sizes: dict[str, tuple[int, int]] | None = None
    unique_items: tuple[str, ...] = ()
    conversions: dict[str, tuple[str, str]] | None = None  # typed column: raw column, kind
    rescued: str | None = None

    def rules(self, rows: DataFrame) -> list[Rule]:
        """Generic rules, always in this order."""
        out = [Rule(f"{c}_required", P.missing(rows, c)) for c in self.required]
        out += [Rule(f"{c}_uuid_format", P.malformed(F.col(c), P.UUID_FORMAT)) for c in self.uuids]
        out += [Rule(f"{c}_country_code_format", P.malformed(F.col(c), P.COUNTRY_FORMAT)) for c in self.countries]
        out += [Rule(f"{c}_ip_address_format", P.malformed(F.col(c), P.IP_FORMAT)) for c in self.addresses]
        out += [Rule(f"{c}_approved_value", P.not_one_of(F.col(c), v)) for c, v in (self.allowed or {}).items()]
        out += [Rule(f"{c}_approved_values", P.some_not_of(F.col(c), v)) for c, v in (self.allowed_elements or {}).items()]
        out += [Rule(f"{c}_array_size", P.bad_size(F.col(c), *v)) for c, v in (self.sizes or {}).items()]
        out += [Rule(f"{c}_unique_items", P.repeats(F.col(c))) for c in self.unique_items]
        out += [Rule(f"{c}_{kind}_conversion", P.lost_in_conversion(F.col(raw), F.col(c))) for c, (raw, kind) in (self.conversions or {}).items()]
        if self.rescued:
            out.append(Rule("bronze_rescued_data_present", P.is_rescued(F.col(self.rescued))))
        return out


def with_reasons(rows: DataFrame, rules: list[Rule]) -> DataFrame:
    """Adds the array of reasons; reasons that are there already stay first, and none comes twice."""
    own = F.array_compact(F.array(*(F.when(r.condition, F.lit(r.name)) for r in rules))) if rules else F.array().cast("array<string>")
    return rows.withColumn(REASONS, F.array_union(F.col(REASONS), own) if REASONS in rows.columns else own)


def valid_rows(rows: DataFrame) -> DataFrame:
    """Rows without a reason, reasons dropped."""
    return rows.filter(F.size(REASONS) == 0).drop(REASONS)


def quarantined_rows(rows: DataFrame) -> DataFrame:
    """Rows with reasons, joined by semicolons."""
    return rows.filter(F.size(REASONS) > 0).withColumn("quarantine_reason", F.concat_ws(";", REASONS)).drop(REASONS)


def reason_counts(rows: DataFrame) -> DataFrame:
    """How many rows each reason has."""
    return rows.select(F.explode(REASONS).alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


def missing_parent(rows: DataFrame, column: str, parents: DataFrame, key: str, reason: str, condition: Column | None = None) -> DataFrame:
    """Adds a reason where a present key has no parent (or none that a condition on the parent holds for).

    Catalyst broadcasts the keys if they are small; otherwise both sides are shuffled, and adaptive execution
    splits the partition that rows with a null key, which never match, fall into.
    """
    keys = parents.filter(condition) if condition is not None else parents
    keys = keys.select(F.col(key).alias("_parent")).filter("_parent IS NOT NULL").distinct()
    joined = rows.join(keys, rows[column] == keys["_parent"], "left")
    bad = F.col(column).isNotNull() & F.col("_parent").isNull()
    return with_reasons(
        joined.withColumn(REASONS, F.col(REASONS) if REASONS in rows.columns else F.array().cast("array<string>")),
        [Rule(reason, bad)],
    ).drop("_parent")


def null_keys(rows: DataFrame, *keys: str) -> DataFrame:
    """Number of rows with a null in the key."""
    return rows.filter(P.any_null(*keys)).agg(F.count("*").alias("n"))


def duplicate_extra_rows(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows beyond the first of each key; rows with a null key are not counted."""
    counts = rows.filter(P.all_present(*keys)).groupBy(*keys).agg(F.count("*").alias("_n"))
    return counts.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("n"))


def duplicate_keys(rows: DataFrame, *keys: str) -> DataFrame:
    """Keys that come more than once; a null is a key like others."""
    return rows.groupBy(*keys).agg(F.count("*").alias("_n")).filter("_n > 1").agg(F.count("*").alias("n"))


def orphans(rows: DataFrame, column: str, parents: DataFrame, key: str) -> DataFrame:
    """Rows whose present key has no parent."""
    return rows.filter(F.col(column).isNotNull()).join(parents.select(F.col(key).alias("_parent")), F.col(column) == F.col("_parent"), "left_anti")


def checks(*named: tuple[str, DataFrame]) -> DataFrame:
    """A row per check: its name, its number of failures (column n of a one-row frame), PASS or FAIL."""
    rows = reduce(
        DataFrame.unionByName,
        (df.select(F.lit(name).alias("check_name"), F.col("n").cast("long").alias("failures")) for name, df in named),
    )
    return rows.withColumn("status", F.when(F.col("failures") == 0, "PASS").otherwise("FAIL"))


def overall(rows: DataFrame) -> DataFrame:
    """PASS if no check failed."""
    return rows.agg(F.sum("failures").cast("long").alias("failures"), F.when(F.sum("failures") == 0, "PASS").otherwise("FAIL").alias("status"))


def failed_paths(report: dict, prefix: str = "") -> list[str]:
    """Paths of all false leaves of a nested report."""
    out = []
    for key, value in report.items():
        path = f"{prefix}.{key}" if prefix else str(key)
        out += failed_paths(value, path) if isinstance(value, dict) else [path] if value is False else []
    return out


def transformation_matrix(before: T.StructType, after: T.StructType, rules: TableRules | None = None) -> list[dict]:
    """For each column of the result: type before and after, what was done, and the kinds of rules that it is under."""
    old = {f.name: f.dataType.simpleString() for f in before}
    own = rules or TableRules()
    kinds = {
        "required": own.required,
        "uuid_format": own.uuids,
        "country_code": own.countries,
        "ip_address": own.addresses,
        "approved_values": [*(own.allowed or {}), *(own.allowed_elements or {})],
        "array_size": own.sizes or {},
        "unique_items": own.unique_items,
        "conversion": own.conversions or {},
    }
    out = []
    for f in after:
        kind = f.dataType.simpleString()
        change = "added" if f.name not in old else "kept" if old[f.name] == kind else "converted"
        out.append({
            "column": f.name,
            "from": old.get(f.name),
            "to": kind,
            "change": change,
            "rules": ";".join(k for k, names in kinds.items() if f.name in names),
        })
    return out


def json_problems(rows: DataFrame, column: str, required: dict[str, str], optional: dict[str, str] | None = None, closed: bool = True) -> DataFrame:
    """Adds _problems to rows of JSON records: fields that are missing, of another type or (if closed) not in the contract.

    required and optional: field to SQL type.  A field's JSON text must be readable as its type.
    """
    fields = required | (optional or {})
    record = F.from_json(column, "map<string,string>")
    value = lambda f: F.element_at(F.col("_record"), F.lit(f))
    missing = [F.when(value(f).isNull(), F.lit(f"{f}_missing")) for f in required]
    mistyped = [F.when(value(f).isNotNull() & value(f).try_cast(t).isNull(), F.lit(f"{f}_not_{t}")) for f, t in fields.items()]
    unknown = F.transform(F.array_sort(F.filter(F.map_keys("_record"), lambda k: ~k.isin(*fields))), lambda k: F.concat(k, F.lit("_unexpected")))
    found = F.concat(F.array_compact(F.array(*missing, *mistyped)), unknown if closed else F.array().cast("array<string>"))
    bad = F.array(F.lit("not_a_record"))
    return rows.withColumn("_record", record).withColumn(
        "_problems",
        F.when(F.col("_record").isNull() | (F.size("_record") == 0) & ~F.trim(F.col(column)).rlike(r"^\{\s*\}$"), bad).otherwise(found),
    ).drop("_record")


def schema_checks(rows: DataFrame, expected: T.StructType) -> DataFrame:
    """Rows, missing, unexpected and mistyped columns, and columns out of order, as check rows (row_count is never a failure)."""
    from sluice.sources.tables import schema_problems

    found = schema_problems(rows, expected)
    order = [c for c in rows.columns if c in expected.fieldNames()] != [c for c in expected.fieldNames() if c in rows.columns]
    counts = [(f"{k}_columns", len(v)) for k, v in found.items()] + [("columns_out_of_order", int(order))]
    static = rows.sparkSession.createDataFrame(counts, "check_name string, failures long")
    empty = rows.agg(F.lit("no_rows").alias("check_name"), (F.count("*") == 0).cast("long").alias("failures"))
    return static.unionByName(empty).withColumn("status", F.when(F.col("failures") == 0, "PASS").otherwise("FAIL"))


def value_checks(rows: DataFrame, unique: tuple[str, ...], subsets: dict[str, list]) -> DataFrame:
    """Checks that keys are unique, and that a column's values, nulls aside, are among those allowed."""
    odd = [(f"{c}_in_allowed", rows.filter(P.not_one_of(F.col(c), v)).agg(F.count("*").alias("n"))) for c, v in subsets.items()]
    return checks((f"{'_'.join(unique)}_unique", duplicate_keys(rows, *unique)), *odd)


def label_timing(labels: DataFrame, transactions: DataFrame, key: str, labelled: str, happened: str) -> DataFrame:
    """Labels without their transaction or that lie before it, with the reason."""
    paid = transactions.select(F.col(key).alias("_key"), F.col(happened).alias("_at"))
    joined = labels.join(paid, F.col(key) == F.col("_key"), "left")
    reason = F.when(F.col("_key").isNull(), "no_transaction").when(F.col(labelled) < F.col("_at"), "before_transaction")
    return joined.withColumn("reason", reason).filter("reason IS NOT NULL").drop("_key", "_at")


def gaps(rows: DataFrame, key: str, ts: str, step: str) -> DataFrame:
    """Points of each key's regular grid, from its first to its last, that have no row."""
    grid = rows.groupBy(key).agg(F.min(ts).alias("_a"), F.max(ts).alias("_b")).select(
        key,
        F.explode(F.expr(f"sequence(_a, _b, interval {step})")).alias(ts),
    )
    return grid.join(rows.select(key, ts), [key, ts], "left_anti")


# Rules of the domain's tables, as (name, condition); amounts are decimals.


def transaction_rules(tolerance: float = 0.01) -> list[Rule]:
    """Order of times, signs, wallets by type, and amount = quantity x price."""
    c = F.col
    false = F.lit(False)
    kind, source, target = c("transaction_type"), c("source_wallet_id"), c("destination_wallet_id")
    return [
        Rule("event_timestamp_after_source_timestamp", P.out_of_order(c("event_timestamp"), c("source_timestamp"))),
        Rule("source_timestamp_after_ingestion_timestamp", P.out_of_order(c("source_timestamp"), c("ingestion_timestamp"))),
        Rule("crypto_quantity_not_positive", F.coalesce(c("crypto_quantity") <= 0, false)),
        Rule("market_price_usd_not_positive", F.coalesce(c("market_price_usd") <= 0, false)),
        Rule("transaction_amount_usd_negative", F.coalesce(c("transaction_amount_usd") < 0, false)),
        Rule("source_and_destination_wallet_identical", F.coalesce(source == target, false)),
        Rule("deposit_missing_destination_wallet_id", (kind == "DEPOSIT") & target.isNull()),
        Rule("outgoing_transaction_missing_source_wallet_id", kind.isin("WITHDRAWAL", "TRANSFER") & source.isNull()),
        Rule("outgoing_transaction_missing_destination_wallet_id", kind.isin("WITHDRAWAL", "TRANSFER") & target.isNull()),
        Rule(
            "transaction_amount_mismatch_quantity_times_price",
            F.coalesce(F.abs(c("transaction_amount_usd") - (c("crypto_quantity") * c("market_price_usd")).cast("decimal(20,8)")) > tolerance, false),
        ),
    ]


def candle_rules(granularity: int = 60) -> list[Rule]:
    """Signs, interval and the order of open, high, low and close."""
    c, false = F.col, F.lit(False)
    o, h, l, e = (c(f"{x}_price_usd") for x in ("open", "high", "low", "close"))  # noqa: E741
    start, end = c("candle_start_timestamp"), c("candle_end_timestamp")
    return [
        *(Rule(f"{n}_price_usd_not_positive", F.coalesce(x <= 0, false)) for n, x in (("open", o), ("high", h), ("low", l), ("close", e))),
        Rule("volume_negative", F.coalesce(c("volume") < 0, false)),
        Rule(f"granularity_not_{granularity}_seconds", F.coalesce(c("granularity_seconds") != granularity, false)),
        Rule(f"candle_end_not_start_plus_{granularity}_seconds", F.coalesce(end != start + F.expr(f"interval {granularity} seconds"), false)),
        Rule("high_price_below_ohlc_values", F.coalesce((h < o) | (h < e) | (h < l), false)),
        Rule("low_price_above_ohlc_values", F.coalesce((l > o) | (l > e) | (l > h), false)),
    ]


def label_rules() -> list[Rule]:
    """Order of times and agreement of flag, type and status."""
    c, false = F.col, F.lit(False)
    return [
        Rule("event_timestamp_after_source_timestamp", P.out_of_order(c("event_timestamp"), c("source_timestamp"))),
        Rule("source_timestamp_after_ingestion_timestamp", P.out_of_order(c("source_timestamp"), c("ingestion_timestamp"))),
        Rule("event_timestamp_not_equal_label_timestamp", F.coalesce(c("event_timestamp") != c("label_timestamp"), false)),
        Rule("fraud_type_required_for_fraud", F.coalesce(c("is_fraud"), false) & c("fraud_type").isNull()),
        Rule("fraud_type_must_be_null_for_non_fraud", F.coalesce(~c("is_fraud"), false) & c("fraud_type").isNotNull()),
        Rule("confirmed_fraud_status_requires_is_fraud_true", F.coalesce((c("investigation_status") == "CONFIRMED_FRAUD") & ~c("is_fraud"), false)),
        Rule("cleared_status_requires_is_fraud_false", F.coalesce((c("investigation_status") == "CLEARED") & c("is_fraud"), false)),
    ]


def authentication_rules() -> list[Rule]:
    """Order of times."""
    c = F.col
    return [
        Rule("event_timestamp_after_source_timestamp", P.out_of_order(c("event_timestamp"), c("source_timestamp"))),
        Rule("source_timestamp_after_ingestion_timestamp", P.out_of_order(c("source_timestamp"), c("ingestion_timestamp"))),
    ]


def date_rules(dates: dict[str, str]) -> list[Rule]:
    """Partition dates (date column: timestamp column) that are not their timestamps'."""
    return [Rule(f"{d}_not_derived_from_{ts}", P.date_differs(F.col(d), F.col(ts))) for d, ts in dates.items()]


def master_rules(table: str) -> list[Rule]:
    """accounts: updates and amounts; devices: last seen after first; wallets have none beyond the generic ones."""
    c, false = F.col, F.lit(False)
    if table == "accounts":
        return [
            Rule("updated_at_before_created_at", P.out_of_order(c("created_at"), c("updated_at"))),
            Rule("normal_transaction_amount_usd_negative", F.coalesce(c("normal_transaction_amount_usd") < 0, false)),
            Rule("normal_transaction_frequency_per_day_negative", F.coalesce(c("normal_transaction_frequency_per_day") < 0, false)),
        ]
    if table == "devices":
        return [Rule("last_seen_at_before_first_seen_at", P.out_of_order(c("first_seen_at"), c("last_seen_at")))]
    return []


def cascade(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Cross-table rules: each table is checked against the valid rows of those it points to, so bad parents take their children along."""
    out = dict(tables)
    good = lambda name: valid_rows(out[name])
    out["devices"] = missing_parent(out["devices"], "primary_account_id", good("accounts"), "account_id", "primary_account_not_found")
    out["wallets"] = missing_parent(out["wallets"], "owner_account_id", good("accounts"), "account_id", "owner_account_not_found")
    for name in ("authentications", "transactions"):
        if name in out:
            out[name] = missing_parent(out[name], "account_id", good("accounts"), "account_id", "account_not_found")
            out[name] = missing_parent(out[name], "device_id", good("devices"), "device_id", "device_not_found")
    if "transactions" in out:
        wallets, customer = good("wallets"), F.col("wallet_type") == "CUSTOMER"
        for side in ("source", "destination"):
            out["transactions"] = missing_parent(out["transactions"], f"{side}_wallet_id", wallets, "wallet_id", f"{side}_wallet_not_found")
        for side, kinds in (("destination", ("DEPOSIT",)), ("source", ("WITHDRAWAL", "TRANSFER"))):
            own = out["transactions"].withColumn("_key", F.when(F.col("transaction_type").isin(*kinds), F.col(f"{side}_wallet_id")))
            out["transactions"] = missing_parent(own, "_key", wallets, "wallet_id", f"{side}_wallet_not_of_a_customer", customer).drop("_key")
    if "labels" in out:
        paid = good("transactions").select(F.col("transaction_id").alias("_id"), F.col("event_timestamp").alias("_at"))
        joined = out["labels"].join(paid, F.col("transaction_id") == F.col("_id"), "left")
        rules = [
            Rule("transaction_not_found", F.col("transaction_id").isNotNull() & F.col("_id").isNull()),
            Rule("label_before_transaction", P.out_of_order(F.col("_at"), F.col("label_timestamp"))),
        ]
        out["labels"] = with_reasons(joined, rules).drop("_id", "_at")
    return out


def incomplete_metadata(rows: DataFrame, *columns: str) -> DataFrame:
    """Number of rows with a null or blank metadata column."""
    blank = reduce(lambda a, b: a | b, (P.missing(rows, c) for c in columns))
    return rows.filter(blank).agg(F.count("*").alias("n"))


def from_the_future(rows: DataFrame, known: str, used: str) -> DataFrame:
    """Rows that use something known only later, such as a candle that ends after the event it is joined to."""
    return rows.filter(P.out_of_order(F.col(known), F.col(used)))


def negative_counts(rows: DataFrame, *columns: str) -> DataFrame:
    """Negative values of each column, in one row."""
    return rows.agg(*(F.count(F.when(F.col(c) < 0, 1)).alias(c) for c in columns))


def final_table_check(rows: DataFrame, key: str, status: str, good: str = "VALID") -> DataFrame:
    """Checks of a finished table: null keys, keys that repeat, rows with another status."""
    odd = rows.filter(~F.col(status).eqNullSafe(F.lit(good))).agg(F.count("*").alias("n"))
    return checks(("null_keys", null_keys(rows, key)), ("repeated_keys", duplicate_keys(rows, key)), ("other_status", odd))


def integrity_report(tables: dict[str, DataFrame], links: list[tuple[str, str, str, str]]) -> DataFrame:
    """A check per link (table, column, parent, key): how many present keys have no parent."""
    found = [(f"{t}.{c}->{p}.{k}", orphans(tables[t], c, tables[p], k).agg(F.count("*").alias("n"))) for t, c, p, k in links]
    return checks(*found)
