"""Silver: standardised, cleaned, enriched and deduplicated records.

Every step is DataFrame -> DataFrame and can be used alone. ``transform_claims`` runs them with
the one shuffle they need, the deduplication, placed before cleaning: it compares only the key
and the lineage columns, which cleaning leaves alone, so the result is the same and the shuffle
carries nine raw columns instead of sixteen.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimloom.functions import rules
from claimloom.functions import vocabulary as V
from claimloom.functions.predicates import all_present
from claimloom.schemas import CLAIM_COLUMNS, SCHEMAS, required_columns

# What decides which version of a claim is the latest; carried as far as the deduplication.
VERSION_COLUMNS = ("_ingested_at", "_record_id")


def standardize_columns(df: DataFrame, columns: Sequence[str] = CLAIM_COLUMNS) -> DataFrame:
    """Exactly the given columns, in order, as text; absent ones are null. Version columns stay."""
    have = set(df.columns)
    wanted = [
        (F.col(c).cast("string") if c in have else F.lit(None).cast("string")).alias(c) for c in columns
    ]
    return df.select(*wanted, *[c for c in VERSION_COLUMNS if c in have])


def drop_null_keys(df: DataFrame) -> DataFrame:
    return df.where(all_present(required_columns(SCHEMAS["claims"])))


def fill_defaults(df: DataFrame) -> DataFrame:
    """Constants for a missing amount, status or description; missing dates stay null."""
    return df.fillna({"claim_amount": "0.0", "status": V.UNKNOWN, "description": V.NO_DESCRIPTION})


def normalize_values(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "claim_amount": rules.clean_amount(F.col("claim_amount")),
            "submitted_date": rules.clean_date(F.col("submitted_date")),
            "resolution_date": rules.clean_date(F.col("resolution_date")),
            "status": rules.clean_status(F.col("status")),
            "claim_type": rules.clean_claim_type(F.col("claim_type")),
        }
    )


def add_features(df: DataFrame) -> DataFrame:
    submitted = F.col("submitted_date")
    return df.withColumns(
        {
            "claim_amount_category": rules.amount_category(F.col("claim_amount")),
            "days_to_resolution": rules.days_to_resolution(submitted, F.col("resolution_date")),
            **rules.date_parts(submitted, "submitted_"),
        }
    )


def keep_latest(df: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """One row per key, the first by ``order``.

    Spark turns "row number = 1" into a group limit that already runs before the shuffle, so a
    key with a third of all rows leaves each task as one row. The hash in front of the key speeds
    up the sorts: ids often share their first characters, hashes do not.
    """
    hashed = df.withColumn("__hash", F.xxhash64(key))
    rank = F.row_number().over(Window.partitionBy("__hash", key).orderBy(*order))
    return hashed.withColumn("__rank", rank).where(F.col("__rank") == 1).drop("__hash", "__rank")


def deduplicate(df: DataFrame, key: str = "claim_id") -> DataFrame:
    """Latest load of each key; among equals the lowest record id, then the smallest row."""
    newest = [F.col("_ingested_at").desc()] if "_ingested_at" in df.columns else []
    first = [F.col("_record_id").asc()] if "_record_id" in df.columns else []
    rest = [F.col(c).asc() for c in df.columns if c != key and c not in VERSION_COLUMNS]
    return keep_latest(df, key, [*newest, *first, *rest])


def add_transformation_metadata(df: DataFrame, run_ts: dt.datetime | str) -> DataFrame:
    """The run's own timestamp and the rule version: arguments, so a rerun gives equal rows."""
    return df.withColumns(
        {
            "_transformed_at": F.lit(run_ts).cast("timestamp_ntz"),
            "_transformation_version": F.lit(V.TRANSFORMATION_VERSION),
        }
    )


def latest_claims(bronze: DataFrame) -> DataFrame:
    """The latest raw version of each claim, as text, with its version columns.

    Of what this keeps and further loads it keeps the same again, so states built load by load equal one full run.
    """
    return bronze.transform(standardize_columns).transform(drop_null_keys).transform(deduplicate)


def transform_claims(bronze: DataFrame, run_ts: dt.datetime | str) -> DataFrame:
    return clean_claims(latest_claims(bronze), run_ts)


def clean_claims(latest: DataFrame, run_ts: dt.datetime | str) -> DataFrame:
    """Clean and enrich rows of ``latest_claims``."""
    return (
        latest.drop(*VERSION_COLUMNS)
        .transform(fill_defaults)
        .transform(normalize_values)
        .transform(add_features)
        .transform(add_transformation_metadata, run_ts)
    )


def transform_customers(df: DataFrame, run_ts: dt.datetime | str) -> DataFrame:
    """Mask personal data and clean contact fields in place."""
    cleaning: Mapping[str, Column] = {
        "customer_ssn": rules.mask_ssn(F.col("customer_ssn")),
        "customer_address": rules.mask_address(F.col("customer_address")),
        "customer_email": rules.clean_email(F.col("customer_email")),
        "customer_phone": rules.clean_phone(F.col("customer_phone")),
    }
    return df.withColumns({**cleaning, "_transformed_at": F.lit(run_ts).cast("timestamp_ntz")})
