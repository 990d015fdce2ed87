"""Explicit table schemas; nothing in the library infers types from data."""

from __future__ import annotations

from pyspark.sql import types as T

# The column layout of the three source tables.
SCHEMAS: dict[str, T.StructType] = {
    "claims": T.StructType()
    .add("claim_id", "string", nullable=False)
    .add("policy_id", "string", nullable=False)
    .add("customer_name", "string")
    .add("claim_type", "string")
    .add("claim_amount", T.DecimalType(10, 2))
    .add("description", "string")
    .add("submitted_date", "date", nullable=False)
    .add("resolution_date", "date")
    .add("status", "string"),
    "customers": T.StructType()
    .add("customer_id", "string", nullable=False)
    .add("policy_id", "string", nullable=False)
    .add("customer_name", "string")
    .add("customer_email", "string")
    .add("customer_phone", "string")
    .add("customer_ssn", "string")
    .add("customer_income", T.DecimalType(12, 2))
    .add("customer_address", "string")
    .add("signup_date", "date"),
    "claim_notes": T.StructType()
    .add("claim_id", "string", nullable=False)
    .add("note_id", "string", nullable=False)
    .add("adjuster_name", "string")
    .add("note_text", "string")
    .add("note_date", "date")
    .add("fraud_indicator", "string")
    .add("severity_level", "integer"),
}

CORRUPT_COLUMN = "_corrupt_record"
LINEAGE_COLUMNS = ("_ingested_at", "_ingested_from", "_source_name", "_record_id")
CLAIM_COLUMNS = tuple(SCHEMAS["claims"].fieldNames())


def schema_for(table: str) -> T.StructType:
    """Look up a registered schema; an unknown name is an error that lists the known ones."""
    try:
        return SCHEMAS[table]
    except KeyError:
        raise KeyError(f"no schema named {table!r}; known: {sorted(SCHEMAS)}") from None


def as_strings(schema: T.StructType) -> T.StructType:
    """The same columns, all as nullable strings: raw cells are kept and typed in silver."""
    return T.StructType([T.StructField(name, T.StringType()) for name in schema.fieldNames()])


def required_columns(schema: T.StructType) -> list[str]:
    """Columns declared non-null. File readers do not enforce this, so callers must filter."""
    return [field.name for field in schema.fields if not field.nullable]
