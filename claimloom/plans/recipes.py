"""Raw claims, customers and notes derived from the given tables, dirt included.

Every row of the source table gives a record (one order in twenty also a later version of its
claim), so the work grows with the tables. The remainders only choose how a cell is written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimloom.sources.readers import parse_json, read_parquet

# Load times of the first and of the second version of a claim.
FIRST_LOAD = "2025-01-01 00:00:00"
SECOND_LOAD = "2025-01-02 00:00:00"
PROPS_SCHEMA = T.StructType().add("k", "integer")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


def _padded(number: Column, width: int) -> Column:
    """Leading zeros up to ``width`` digits; a longer number stays whole."""
    digits = number.cast("string")
    return F.lpad(digits, F.greatest(F.lit(width), F.char_length(digits)), F.lit("0"))


def _null_if(condition: Column, value: Column) -> Column:
    return F.when(~condition, value)


def _pick(position: Column, *choices: str) -> Column:
    """The choice at a zero-based position."""
    return F.get(F.array(*[F.lit(c) for c in choices]), position.cast("int"))


def _written_date(date: Column, k: Column) -> Column:
    forms = _pick(k % 7, "$2/$3/$1", "$2-$3-$1", "$1$2$3", *["$1-$2-$3"] * 4)
    return F.regexp_replace(date.cast("string"), F.lit(r"^(\d+)-(\d+)-(\d+)$"), forms)


def _written_amount(cents: Column, k: Column) -> Column:
    grouped = F.format_number(cents / 100, 2)
    dollars = F.concat(F.when(k % 4 == 1, "$").otherwise(""), F.translate(grouped, ",", ""))
    return F.when(k % 67 == 4, "n/a").when(k % 4 == 2, grouped).otherwise(dollars)


def raw_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("k"),
        F.col("o_custkey").alias("ck"),
        F.col("o_orderdate").cast("date").alias("od"),
        F.round(F.col("o_totalprice") * 10).cast("bigint").alias("cents"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_orderpriority").alias("priority"),
        F.explode(F.sequence(F.lit(1), F.when(F.col("o_orderkey") % 20 == 3, 2).otherwise(1))).alias("v"),
    )
    k, ck, od = F.col("k"), F.col("ck"), F.col("od")
    types = ("Automobile", " HOME ", "medical", "Life", "disab")
    claim_type = F.when(k % 41 == 2, "Travel").otherwise(
        _pick(F.left("priority", F.lit(1)).cast("int") - 1, *types)
    )
    status = (
        F.when(F.col("v") == 2, "Approve")
        .when(k % 43 == 8, "RESOLVED")
        .when(k % 6 == 0, "rejected")
        .otherwise(_pick(F.position("order_status", F.lit("FOP")) - 1, "Closed", " pend", "In_Review"))
    )
    duration = ((k * 37) % 199 - 10).cast("int")
    submitted = F.when(k % 103 == 10, F.lit("not a date")).otherwise(_written_date(od, k))
    load = F.when(F.col("v") == 1, FIRST_LOAD).otherwise(SECOND_LOAD)
    return orders.select(
        _null_if(k % 211 == 7, F.concat(F.lit("CLM-"), _padded(k, 9))).alias("claim_id"),
        _null_if(k % 97 == 5, F.concat(F.lit("POL-"), _padded(ck, 6))).alias("policy_id"),
        F.concat(F.lit("Customer "), ck.cast("string")).alias("customer_name"),
        _null_if(k % 53 == 1, claim_type).alias("claim_type"),
        _null_if(k % 61 == 3, _written_amount(F.col("cents"), k)).alias("claim_amount"),
        _null_if(k % 71 == 11, F.col("priority")).alias("description"),
        _null_if(k % 101 == 9, submitted).alias("submitted_date"),
        _null_if(k % 5 == 0, _written_date(F.date_add(od, duration), k)).alias("resolution_date"),
        _null_if(k % 59 == 6, status).alias("status"),
        load.cast("timestamp_ntz").alias("_ingested_at"),
        (k * 2 + F.col("v")).alias("_record_id"),
    )


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")

    def text(*parts: Column | str) -> Column:
        return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])

    email = (
        F.when(k % 13 == 2, "no-at-sign.example")
        .when(k % 11 == 1, "nodot@localhost")
        .otherwise(text(" User", k, "@Example.COM "))
    )
    phone = F.when(k % 19 == 5, "555-0199").otherwise(text("+1 (", k % 700 + 200, ") 555-", _padded(k % 10000, 4)))
    ssn = F.when(k % 29 == 7, " 12 ").otherwise(text(k % 800 + 100, "-", k % 80 + 10, "-", _padded(k % 10000, 4)))
    address = F.when(k % 37 == 9, "   ").otherwise(
        text(k, " Main  Street Apt ", k % 50, ", Town, ST ", _padded(k % 100000, 5))
    )
    return customer.select(
        text("CUST-", _padded(k, 6)).alias("customer_id"),
        text("POL-", _padded(k, 6)).alias("policy_id"),
        F.col("c_name").alias("customer_name"),
        _null_if(k % 17 == 3, email).alias("customer_email"),
        _null_if(k % 23 == 4, phone).alias("customer_phone"),
        _null_if(k % 31 == 6, ssn).alias("customer_ssn"),
        (F.col("c_acctbal") * 10).cast("decimal(12,2)").alias("customer_income"),
        _null_if(k % 41 == 8, address).alias("customer_address"),
        F.date_add(F.lit("2020-01-01").cast("date"), (k % 1461).cast("int")).alias("signup_date"),
    )


def claim_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two notes per claim; the severity comes out of a JSON text column."""
    events = table(spark, sf_dir, "events")
    props = parse_json(F.col("props"), PROPS_SCHEMA)
    event = F.col("event_type")
    return events.select(
        F.concat(F.lit("CLM-"), _padded(F.floor(F.col("event_id") / 2), 9)).alias("claim_id"),
        F.concat(F.lit("NOTE-"), _padded(F.col("event_id"), 8)).alias("note_id"),
        F.concat(F.lit("Adjuster "), F.col("user_id").cast("string")).alias("adjuster_name"),
        F.concat(F.lit("observed "), event).alias("note_text"),
        F.col("ts").cast("date").alias("note_date"),
        F.when(event == "error", "Y").when(event.isin("click", "view"), "N").otherwise("UNKNOWN").alias(
            "fraud_indicator"
        ),
        (props["k"] % 5 + 1).cast("int").alias("severity_level"),
    )


def mailed_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with postal addresses of several lines, some with quotes."""
    lines = F.regexp_replace("customer_address", ", ", "\n")
    quoted = F.when(F.col("customer_id").endswith("3"), F.concat(F.lit('"c/o"\n'), lines)).otherwise(lines)
    return raw_customers(spark, sf_dir).withColumn("customer_address", quoted)


def write_json_arrays(df: DataFrame, path: str, key: str, files: int = 4) -> None:
    """Pretty-printed arrays, one a file; rows go to files by key."""
    row = F.struct("__k", F.to_json(F.struct(*df.columns), {"pretty": "true", "ignoreNullFields": "false"}).alias("text"))
    keyed = df.withColumn("__k", F.xxhash64(key)).withColumn("file", F.pmod("__k", F.lit(files)))
    # A file's text is one row, as its writer holds it; files grow in number, not in size, with the table.
    texts = keyed.groupBy("file").agg(F.sort_array(F.collect_list(row)).alias("rows"))
    joined = F.array_join(F.transform("rows", lambda x: x["text"]), ",\n")
    array = F.concat(F.lit("[\n"), F.regexp_replace(joined, r"(?m)^", "  "), F.lit("\n]"))
    texts.select("file", array.alias("value")).write.partitionBy("file").text(path)
