"""Order states: derivation, records, deterministic ids, history reads and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .. import contract as C
from ..schemas import STATE, STATE_COLUMNS

# Time of the event that decided a state; travels beside the state columns.
DECIDED = "decided_at"

# Canonical key order of the state id document (alphabetical).
STATE_ID_FIELDS = sorted(STATE_COLUMNS)


def status_column(payment: str = "payment_status", inventory: str = "inventory_status") -> Column:
    """failed -> PAYMENT_FAILED; authorized+reserved -> COMPLETED;
    authorized+rejected -> INVENTORY_REJECTED; otherwise UNKNOWN."""
    p, i = F.col(payment), F.col(inventory)
    return (F.when(p == C.PAYMENT_FAILED, F.lit(C.PAYMENT_FAILED_STATE))
            .when((p == C.PAYMENT_AUTHORIZED) & (i == C.INVENTORY_RESERVED), F.lit(C.COMPLETED))
            .when((p == C.PAYMENT_AUTHORIZED) & (i == C.INVENTORY_REJECTED),
                  F.lit(C.INVENTORY_REJECTED_STATE))
            .otherwise(F.lit(C.UNKNOWN)))


def order_status(correlated: DataFrame, with_decision: bool = False) -> DataFrame:
    """Correlated rows -> the seven state columns (and ``decided_at`` on request).

    ``decided_at`` is the time of the event that decided the state -- the inventory result, else
    the payment -- as text; it is not part of the state and not hashed into its id.
    """
    decided = F.coalesce("inventory_time", "payment_time").cast("string").alias("decided_at")
    return correlated.withColumn("order_status", status_column()).select(
        *STATE_COLUMNS, *([decided] if with_decision else []))


def state_record(states: DataFrame) -> DataFrame:
    """``(key, value)``: key = order_id, value = JSON of all state columns (NULLs left out)."""
    return states.select(F.col("order_id").alias("key"),
                         F.to_json(F.struct(*[F.col(c) for c in states.columns])).alias("value"))


def parse_states(records: DataFrame, value_col: str = "value") -> DataFrame:
    """State records -> typed rows + ``order_time_parsed``; rows without the keys are dropped."""
    schema = StructType([*STATE.fields, StructField(DECIDED, StringType())])
    return (records.select(F.from_json(F.col(value_col).cast("string"), schema).alias("s"))
            .select("s.*")
            .withColumn("order_time_parsed", F.try_to_timestamp(F.col("order_time")))
            .filter(F.col("order_id").isNotNull() & F.col("order_time_parsed").isNotNull()
                    & F.col("order_status").isNotNull()))


def number_text(amount: Column) -> Column:
    """Shortest decimal text of a double as JSON writers of most languages print it: plain from
    1e-4 up to 1e16, else with a two-digit exponent (``1e+16``, ``5e-05``).

    Java's text is that of most amounts; only one with an exponent goes through the rewriting."""
    java = amount.cast("string")
    sign = F.when(java.startswith("-"), "-").otherwise("")
    digits = F.regexp_replace(F.regexp_extract(java, r"^-?([0-9.]+)", 1), r"\.", "")
    digits = F.when(F.length(digits) > 1, F.regexp_replace(digits, "0+$", "")).otherwise(digits)
    digits = F.when(digits == "", "0").otherwise(digits)
    power = F.regexp_extract(java, r"E(-?[0-9]+)$", 1).try_cast("int")
    point = power + 1  # digits before the decimal point
    large = F.when(F.length(digits) <= point, F.concat(F.rpad(digits, point, "0"), F.lit(".0"))) \
        .otherwise(F.concat(digits.substr(F.lit(1), point), F.lit("."), digits.substr(point + 1, F.lit(30))))
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -point), digits)
    exponent = F.concat(
        digits.substr(1, 1), F.when(F.length(digits) > 1, F.concat(F.lit("."), digits.substr(F.lit(2), F.lit(30))))
        .otherwise(""), F.when(power < 0, "e-").otherwise("e+"), F.lpad(F.abs(power).cast("string"), 2, "0"))
    long_exponent = F.abs(power) >= 100
    exponent = F.when(long_exponent, F.concat(F.regexp_replace(exponent, "[+-][0-9]+$", ""),
                                              F.when(power < 0, "-").otherwise("+"), F.abs(power).cast("string"))) \
        .otherwise(exponent)
    return F.when(F.instr(java, "E") == 0, java).when(power.isNull(), java).when(power.between(7, 15), F.concat(sign, large)) \
        .when(power == -4, F.concat(sign, small)).otherwise(F.concat(sign, exponent))


def lower_case_escapes(doc: Column) -> Column:
    """JSON text with the hexadecimal letters of control-character escapes in lower case
    (``\\u001f``), as most writers have them; an escaped backslash before ``u`` is no escape."""
    lowered = doc
    for letter in "ABCDEF":
        lowered = F.regexp_replace(lowered, rf"(?<!\\)((?:\\\\)*\\u00[01]){letter}", "$1" + letter.lower())
    return F.when(F.instr(doc, "\\u00") > 0, lowered).otherwise(doc)


def state_id_column() -> Column:
    """SHA-256 hex of the state's canonical JSON (sorted keys, NULLs kept as ``null``).

    A native column: no Python per row, no driver loop.  The amount goes in as
    ``number_text``, so the document equals the sorted-key compact JSON of the seven fields.
    """
    fields = [number_text(F.col(c)).alias(c) if c == "order_amount" else F.col(c) for c in STATE_ID_FIELDS]
    doc = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    # quotes inside values are escaped, so only the amount's own quotes match
    return F.sha2(F.regexp_replace(lower_case_escapes(doc), r'"order_amount":"([^"]*)"', '"order_amount":$1'), 256)


def with_state_id(states: DataFrame) -> DataFrame:
    return states.withColumn("state_id", state_id_column())


HISTORY_COLUMNS = ["order_id", "state_id", "customer_id", "order_amount", "order_time",
                   "payment_status", "inventory_status", "order_status"]


def history_rows(states: DataFrame) -> DataFrame:
    """History-table rows: state columns + ``state_id``, ``order_time`` as a timestamp, and
    ``decided_at`` (a timestamp, NULL where the states do not carry it)."""
    decided = F.try_to_timestamp(F.col(DECIDED)) if DECIDED in states.columns \
        else F.lit(None).cast("timestamp")
    return (with_state_id(states)
            .withColumn("order_time", F.try_to_timestamp(F.col("order_time")))
            .select(*HISTORY_COLUMNS, decided.alias(DECIDED)))


def upsert_view(history: DataFrame) -> DataFrame:
    """Keyed-table read: one row per primary key ``(order_id, state_id)``.

    Equal keys carry equal state columns (the id is a hash of them), so any copy is right; of
    ``decided_at`` the latest stays.  The aggregate is combined map-side, so replayed batches
    cost little.
    """
    if DECIDED not in history.columns:
        return history.dropDuplicates(["order_id", "state_id"])
    others = [c for c in history.columns if c not in ("order_id", "state_id", DECIDED)]
    return (history.groupBy("order_id", "state_id")
            .agg(*[F.any_value(c).alias(c) for c in others], F.max(DECIDED).alias(DECIDED))
            .select(*history.columns))


def distinct_states(states: DataFrame) -> DataFrame:
    """State rows (with ``decided_at``) -> one per state, the latest ``decided_at``: what
    ``upsert_view`` keeps of their history rows, as an id stands for the seven columns.  The amount
    is compared as the text that the id hashes (0.0 and -0.0 differ)."""
    keys = [F.col(c).cast("string").alias("_amount") if c == "order_amount" else F.col(c) for c in STATE_COLUMNS]
    decided = F.max(F.try_to_timestamp(DECIDED)).cast("string")
    return (states.groupBy(*keys).agg(F.any_value("order_amount").alias("order_amount"), decided.alias(DECIDED))
            .select(*STATE_COLUMNS, DECIDED))


def latest_state(history: DataFrame) -> DataFrame:
    """The row of each order decided last (``decided_at``; where that is missing, by
    ``order_time``), ties broken by ``state_id``.  One aggregate, no window; merging its own
    results with more rows gives what all rows give."""
    others = [c for c in history.columns if c not in ("order_id",)]
    when = [c for c in (DECIDED, "order_time") if c in history.columns]
    latest = F.max_by(F.struct(*others), F.struct(*when, "state_id"))
    return (history.groupBy("order_id").agg(latest.alias("_s"))
            .select("order_id", *[F.col(f"_s.{c}").alias(c) for c in others]))


def current_state(history: DataFrame) -> DataFrame:
    """Latest state per order, without the time of its decision."""
    return latest_state(history).drop(DECIDED)


def multi_state_orders(history: DataFrame) -> DataFrame:
    """Orders with more than one emitted state row (legal, e.g. two payments), with the number
    of distinct statuses and of distinct state ids (what a keyed table keeps)."""
    return (history.groupBy("order_id")
            .agg(F.count(F.lit(1)).alias("state_count"),
                 F.count_distinct("order_status").alias("distinct_statuses"),
                 F.count_distinct("state_id").alias("distinct_state_ids"))
            .filter(F.col("state_count") > 1))


def status_counts(states: DataFrame) -> DataFrame:
    return states.groupBy("order_status").agg(F.count(F.lit(1)).alias("order_count"))


def expected_state_check(states: DataFrame, expected: DataFrame) -> DataFrame:
    """Per expected ``(order_id, expected_status)``: rows found with that status, and with any.

    ``expected`` is a table of expectations (joined, not collected).
    """
    s = states.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("state_rows"),
        F.collect_set("order_status").alias("_statuses"))
    return (expected.join(s, "order_id", "left")
            .select("order_id", "expected_status",
                    F.coalesce(F.col("state_rows"), F.lit(0)).alias("state_rows"),
                    F.coalesce(F.array_contains("_statuses", F.col("expected_status")), F.lit(False))
                    .alias("matched")))


def order_lookup(history: DataFrame, order_id: str | Column) -> DataFrame:
    """Point lookup by partition key (pushed to the scan as an equality filter)."""
    value = order_id if isinstance(order_id, Column) else F.lit(order_id)
    return history.filter(F.col("order_id") == value).select("order_id", "order_status")


def lookup_many(history: DataFrame, keys: DataFrame) -> DataFrame:
    """Lookups for a key table: a semi-join on the partition key (no per-key driver loop)."""
    return (history.join(keys.select("order_id"), "order_id", "left_semi")
            .select("order_id", "order_status", "state_id"))
