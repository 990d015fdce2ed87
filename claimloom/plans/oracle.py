"""The registered queries as DuckDB SQL over the same tables, written independently of the operators."""

from __future__ import annotations

from claimloom.functions import vocabulary as V


def _date_text(date: str) -> str:
    return f"""case k % 7 when 0 then strftime({date}, '%m/%d/%Y') when 1 then strftime({date}, '%m-%d-%Y')
        when 2 then strftime({date}, '%Y%m%d') else strftime({date}, '%Y-%m-%d') end"""


def _read_amount(text: str) -> str:
    return f"coalesce(try_cast(trim(replace(replace({text}, '$', ''), ',', '')) as double), 0.0)"


def _read_date(text: str) -> str:
    formats = "['%Y-%m-%d', '%m/%d/%Y', '%m-%d-%Y', '%d/%m/%Y', '%Y%m%d']"
    return f"cast(try_strptime(trim({text}), {formats}) as date)"


def _read_word(text: str, words: dict[str, str]) -> str:
    cases = " ".join(f"when '{word}' then '{meaning}'" for word, meaning in words.items())
    return f"case lower(trim({text})) {cases} else 'unknown' end"


def _category(amount: str) -> str:
    return f"case when {amount} < 1000 then 'small' when {amount} < 10000 then 'medium' else 'large' end"


def _days(submitted: str, resolved: str) -> str:
    return f"cast(date_diff('day', {submitted}, {resolved}) as integer)"


def _parts(date: str) -> str:
    return f"""cast(year({date}) as integer) as submitted_year, cast(month({date}) as integer) as submitted_month,
        cast(day({date}) as integer) as submitted_day, cast(quarter({date}) as integer) as submitted_quarter,
        cast(isodow({date}) - 1 as integer) as submitted_day_of_week"""


_MONEY = "cast(claim_amount as decimal(18,2))"
_TOTAL = f"cast(sum({_MONEY}) as double)"
_MEAN = f"cast(sum({_MONEY}) as double) / count(claim_amount)"
_APPROVED = "count(*) filter (where status = 'approved')"

_MARKED = " || ".join(
    f"coalesce(length({text}) || ':' || {text}, '-')"
    for text in (
        "cast(_record_id as varchar)", "strftime(_ingested_at, '%Y-%m-%d')", "claim_id", "policy_id", "submitted_date",
        "status",
    )
)

_CTES = {
    "versions": """
        select o_orderkey as k, o_custkey as ck, cast(o_orderdate as date) as od,
            cast(round(o_totalprice * 10) as bigint) as cents, o_orderstatus, o_orderpriority as priority,
            unnest(range(1, case when o_orderkey % 20 = 3 then 3 else 2 end)) as v
        from orders""",
    "cells": """
        select *, cast(cents // 100 as varchar) || '.' || lpad(cast(cents % 100 as varchar), 2, '0') as plain,
            cast(cents // 100000 as varchar) || ',' || lpad(cast((cents // 100) % 1000 as varchar), 3, '0')
                || '.' || lpad(cast(cents % 100 as varchar), 2, '0') as grouped,
            od + cast((k * 37) % 199 - 10 as integer) as rd
        from versions""",
    "raw": f"""
        select case when k % 211 <> 7 then 'CLM-' || lpad(cast(k as varchar), cast(greatest(9, length(cast(k as varchar))) as integer), '0') end as claim_id,
            case when k % 97 <> 5 then 'POL-' || lpad(cast(ck as varchar), cast(greatest(6, length(cast(ck as varchar))) as integer), '0') end as policy_id,
            'Customer ' || cast(ck as varchar) as customer_name,
            case when k % 53 = 1 then null when k % 41 = 2 then 'Travel'
                else case left(priority, 1) when '1' then 'Automobile' when '2' then ' HOME '
                    when '3' then 'medical' when '4' then 'Life' when '5' then 'disab' end end as claim_type,
            case when k % 61 = 3 then null when k % 67 = 4 then 'n/a' when k % 4 = 1 then '$' || plain
                when k % 4 = 2 and cents >= 100000 then grouped else plain end as claim_amount,
            case when k % 71 <> 11 then priority end as description,
            case when k % 101 = 9 then null when k % 103 = 10 then 'not a date'
                else {_date_text("od")} end as submitted_date,
            case when k % 5 <> 0 then {_date_text("rd")} end as resolution_date,
            case when k % 59 = 6 then null when v = 2 then 'Approve' when k % 43 = 8 then 'RESOLVED'
                when k % 6 = 0 then 'rejected'
                else case o_orderstatus when 'F' then 'Closed' when 'O' then ' pend' when 'P' then 'In_Review' end
                end as status,
            case v when 1 then timestamp '2025-01-01 00:00:00' else timestamp '2025-01-02 00:00:00' end as _ingested_at,
            cast(2 * k + v as bigint) as _record_id
        from cells""",
    "records": """
        select claim_id, policy_id, customer_name, claim_type, claim_amount, description, submitted_date,
            resolution_date, status
        from raw""",
    "keyed": """
        select * from raw where claim_id is not null and policy_id is not null and submitted_date is not null""",
    "latest": """
        select * from keyed
        qualify row_number() over (partition by claim_id order by _ingested_at desc, _record_id) = 1""",
    "customers": """
        select 'CUST-' || lpad(cast(c_custkey as varchar), cast(greatest(6, length(cast(c_custkey as varchar))) as integer), '0') as customer_id,
            'POL-' || lpad(cast(c_custkey as varchar), cast(greatest(6, length(cast(c_custkey as varchar))) as integer), '0') as policy_id, c_name as customer_name,
            case when c_custkey % 17 = 3 then null when c_custkey % 13 = 2 then 'no-at-sign.example'
                when c_custkey % 11 = 1 then 'nodot@localhost'
                else ' User' || cast(c_custkey as varchar) || '@Example.COM ' end as customer_email,
            case when c_custkey % 23 = 4 then null when c_custkey % 19 = 5 then '555-0199'
                else '+1 (' || cast(200 + c_custkey % 700 as varchar) || ') 555-'
                    || lpad(cast(c_custkey % 10000 as varchar), 4, '0') end as customer_phone,
            case when c_custkey % 31 = 6 then null when c_custkey % 29 = 7 then ' 12 '
                else cast(100 + c_custkey % 800 as varchar) || '-' || cast(10 + c_custkey % 80 as varchar) || '-'
                    || lpad(cast(c_custkey % 10000 as varchar), 4, '0') end as customer_ssn,
            cast(cast(c_acctbal * 10 as decimal(12,2)) as double) as customer_income,
            case when c_custkey % 41 = 8 then null when c_custkey % 37 = 9 then '   '
                else cast(c_custkey as varchar) || ' Main  Street Apt ' || cast(c_custkey % 50 as varchar)
                    || ', Town, ST ' || lpad(cast(c_custkey % 100000 as varchar), 5, '0') end as customer_address,
            date '2020-01-01' + cast(c_custkey % 1461 as integer) as signup_date
        from customer""",
    "notes": """
        select 'CLM-' || lpad(cast(event_id // 2 as varchar), cast(greatest(9, length(cast(event_id // 2 as varchar))) as integer), '0') as claim_id,
            'NOTE-' || lpad(cast(event_id as varchar), cast(greatest(8, length(cast(event_id as varchar))) as integer), '0') as note_id,
            'Adjuster ' || cast(user_id as varchar) as adjuster_name, 'observed ' || event_type as note_text,
            cast(ts as date) as note_date,
            case when event_type = 'error' then 'Y' when event_type in ('click', 'view') then 'N'
                else 'UNKNOWN' end as fraud_indicator,
            cast(cast(json_extract_string(props, '$.k') as integer) % 5 + 1 as integer) as severity_level
        from events""",
}


def _normalized(source: str) -> str:
    return f"""select claim_id, policy_id, customer_name, {_read_word("claim_type", V.CLAIM_TYPE_WORDS)} as claim_type,
        {_read_amount("claim_amount")} as claim_amount, description,
        {_read_date("submitted_date")} as submitted_date, {_read_date("resolution_date")} as resolution_date,
        {_read_word("status", V.STATUS_WORDS)} as status, _ingested_at, _record_id
        from {source}"""


def _featured(source: str) -> str:
    return f"""select *, {_category("claim_amount")} as claim_amount_category,
        {_days("submitted_date", "resolution_date")} as days_to_resolution, {_parts("submitted_date")}
        from {source}"""


_CTES["cleaned"] = _normalized("keyed")
_CTES["latest_cleaned"] = _normalized("latest")
_CTES["silver"] = f"""
    select * exclude (_ingested_at, _record_id) replace (coalesce(description, 'NO_DESCRIPTION') as description)
    from ({_featured("latest_cleaned")})"""
_CTES["first_load"] = "select * from raw where _ingested_at <= timestamp '2025-01-01 00:00:00'"
_CTES["first_keyed"] = """
    select * from first_load where claim_id is not null and policy_id is not null and submitted_date is not null"""
_CTES["first_latest"] = """
    select * from first_keyed
    qualify row_number() over (partition by claim_id order by _ingested_at desc, _record_id) = 1"""
_CTES["first_cleaned"] = _normalized("first_latest")
_CTES["first_silver"] = _featured("first_cleaned")


def _sql(body: str) -> str:
    """A query with the whole chain of steps in front; the engine drops what it does not use."""
    steps = ",\n".join(f"{name} as ({text})" for name, text in _CTES.items())
    return f"with {steps}\n{body}"


def _metric_rows(check: str, subject: str, source: str, *metrics: tuple[str, str, str, str]) -> str:
    return "\nunion all ".join(
        f"select '{check}' as \"check\", '{subject}' as subject, '{name}' as metric, cast({value} as double) as value, "
        f"cast({threshold} as double) as threshold, {status} as status from {source}"
        for name, value, threshold, status in metrics
    )


_RECORD_COLUMNS = (
    "claim_id", "policy_id", "customer_name", "claim_type", "claim_amount", "description", "submitted_date",
    "resolution_date", "status",
)
_SILVER_COLUMNS = (
    *_RECORD_COLUMNS, "claim_amount_category", "days_to_resolution", "submitted_year", "submitted_month",
    "submitted_day", "submitted_quarter", "submitted_day_of_week",
)


def _null_rows(source: str, columns: tuple[str, ...]) -> str:
    rows = []
    for c in columns:
        limit = 10 if c in ("claim_id", "policy_id", "submitted_date") else 20
        share = f"(count(*) - count({c})) * 100.0 / count(*)"
        rows.append(
            _metric_rows(
                "null_check", c, source,
                ("null_count", f"count(*) - count({c})", "null", "'INFO'"),
                ("null_percent", f"round_even({share}, 2)", str(limit), f"if({share} > {limit}, 'FAIL', 'PASS')"),
            )
        )
    return "\nunion all ".join(rows)


def _duplicate_rows(source: str) -> str:
    extra = "count(*) - count(distinct claim_id)"
    return _metric_rows(
        "duplicates", "claim_id", source,
        ("total_rows", "count(*)", "null", "'INFO'"),
        ("unique_keys", "count(distinct claim_id)", "null", "'INFO'"),
        ("duplicate_rows", extra, "0", f"if({extra} = 0, 'PASS', 'FAIL')"),
        ("duplicate_percent", f"round_even(({extra}) * 100.0 / count(*), 2)", "null", "'INFO'"),
    )


_RETENTION = "(select (select count(*) from raw) as b, (select count(*) from silver) as a)"
_RETENTION_ROWS = _metric_rows(
    "row_count", "rows", _RETENTION,
    ("rows_before", "b", "null", "'INFO'"),
    ("rows_after", "a", "null", "'INFO'"),
    ("rows_lost", "b - a", "null", "'INFO'"),
    ("retention_rate", "round_even(a / b, 4)", "0.95", "if(a / b >= 0.95, 'PASS', 'FAIL')"),
)
_SIZE_ROWS = _metric_rows(
    "table", "table", "silver",
    ("total_rows", "count(*)", "null", "'INFO'"),
    ("total_columns", f"max({len(_SILVER_COLUMNS)})", "null", "'INFO'"),
)
_RECORD_SIZE_ROWS = _metric_rows(
    "table", "table", "records",
    ("total_rows", "count(*)", "null", "'INFO'"),
    ("total_columns", f"max({len(_RECORD_COLUMNS)})", "null", "'INFO'"),
)
_ALLOWED = ", ".join(f"'{s}'" for s in V.STATUSES)

_FRAUD = """
    select claim_id, policy_id, claim_amount, claim_type, status, days_to_resolution, claim_amount_category,
        submitted_year, submitted_month, high_amount_flag, long_resolution_flag,
        round_even(cast(points as double) / max(points) over () * 100, 2) as fraud_risk_score
    from (
        select *, 4 * high_amount_flag + 3 * long_resolution_flag + if(claim_type = 'auto', 2, 0)
            + if(claim_type = 'home', 1, 0) as points
        from (
            select *, cast(claim_amount >= (select quantile_cont(claim_amount, 0.75) from silver) as integer)
                    as high_amount_flag,
                cast(coalesce(days_to_resolution >= (select quantile_cont(days_to_resolution, 0.75) from silver),
                    false) as integer) as long_resolution_flag
            from silver))"""

_MONTHLY = f"""
    select submitted_year as year, submitted_month as month, claim_amount_category, count(claim_id) as num_claims,
        {_TOTAL} as total_claim_amount, {_MEAN} as avg_claim_amount, min(claim_amount) as min_claim_amount,
        max(claim_amount) as max_claim_amount, round_even(stddev_samp(claim_amount), 4) as std_claim_amount,
        avg(days_to_resolution) as avg_days_to_resolution,
        cast(median(days_to_resolution) as double) as median_days_to_resolution,
        min(days_to_resolution) as min_days_to_resolution, max(days_to_resolution) as max_days_to_resolution,
        {_APPROVED} as approved_count, round_even({_APPROVED} / count(claim_id) * 100, 2) as approval_rate
    from silver where submitted_year is not null
    group by submitted_year, submitted_month, claim_amount_category"""

_STATUS = f"""
    select status, count(claim_id) as num_claims, {_TOTAL} as total_amount, {_MEAN} as avg_amount,
        avg(days_to_resolution) as avg_resolution_days,
        round_even(count(claim_id) / (select count(claim_id) from silver) * 100, 2) as pct_of_total
    from silver group by status"""

_TYPES = f"""
    select claim_type, count(claim_id) as num_claims, {_TOTAL} as total_amount, {_MEAN} as avg_amount,
        median(claim_amount) as median_amount, avg(days_to_resolution) as avg_resolution_days,
        cast(median(days_to_resolution) as double) as median_resolution_days, {_APPROVED} as approved_count,
        round_even({_APPROVED} / count(claim_id) * 100, 2) as approval_rate
    from silver group by claim_type"""

_HIGH_VALUE = """
    select claim_id, policy_id, claim_type, claim_amount, status, submitted_date,
        status = 'pending' as is_pending, claim_amount >= 30000 as is_large_amount
    from silver where claim_amount >= 20000"""

_BUCKET_SPINE = ", ".join(
    f"({i}, {low}, {'null' if high is None else high}, '{label}')"
    for i, (low, high, label) in enumerate(V.RESOLUTION_BUCKETS)
)
_RESOLUTION = f"""
    select b.label as resolution_bucket, b.i as bucket_order, count(s.claim_id) as num_claims,
        cast(sum(cast(s.claim_amount as decimal(18,2))) as double) / nullif(count(s.claim_amount), 0) as avg_amount,
        avg(s.days_to_resolution) as avg_days, cast(median(s.days_to_resolution) as double) as median_days,
        min(s.days_to_resolution) as min_days, max(s.days_to_resolution) as max_days
    from (values {_BUCKET_SPINE}) as b(i, low, high, label)
    left join silver s on s.days_to_resolution > b.low and (b.high is null or s.days_to_resolution <= b.high)
    where exists (select 1 from silver where days_to_resolution is not null)
    group by b.i, b.label"""

_GOLD_COLUMNS = {
    "monthly_summary": "year,month,claim_amount_category,num_claims,total_claim_amount,avg_claim_amount,"
    "min_claim_amount,max_claim_amount,std_claim_amount,avg_days_to_resolution,median_days_to_resolution,"
    "min_days_to_resolution,max_days_to_resolution,approved_count,approval_rate",
    "status_breakdown": "status,num_claims,total_amount,avg_amount,avg_resolution_days,pct_of_total",
    "claim_type_analysis": "claim_type,num_claims,total_amount,avg_amount,median_amount,avg_resolution_days,"
    "median_resolution_days,approved_count,approval_rate",
    "high_value_claims": "claim_id,policy_id,claim_type,claim_amount,status,submitted_date,is_pending,is_large_amount",
    "resolution_time_analysis": "resolution_bucket,bucket_order,num_claims,avg_amount,avg_days,median_days,min_days,"
    "max_days",
    "fraud_risk_features": "claim_id,policy_id,claim_amount,claim_type,status,days_to_resolution,"
    "claim_amount_category,submitted_year,submitted_month,high_amount_flag,long_resolution_flag,fraud_risk_score",
}


def _gold_count(table: str, silver: str) -> str:
    return {
        "monthly_summary": f"(select count(*) from (select distinct submitted_year, submitted_month, "
        f"claim_amount_category from {silver} where submitted_year is not null))",
        "status_breakdown": f"(select count(distinct status) from {silver})",
        "claim_type_analysis": f"(select count(distinct claim_type) from {silver})",
        "high_value_claims": f"(select count(*) from {silver} where claim_amount >= 20000)",
        "resolution_time_analysis": f"(select if(count(days_to_resolution) > 0, 6, 0) from {silver})",
        "fraud_risk_features": f"(select count(*) from {silver})",
    }[table]


_GOLD_SUMMARY = "\nunion all ".join(
    f"select '{name}' as table_name, {_gold_count(name, 'silver')} as row_count, "
    f"cast({len(columns.split(','))} as integer) as column_count, '{columns}' as columns"
    for name, columns in _GOLD_COLUMNS.items()
)


def _run_metric_rows(run_seq: int, raw: str, keyed: str, silver: str) -> str:
    bronze, kept = f"(select count(*) from {raw})", f"(select count(*) from {silver})"
    gold = {f"{name}_rows": _gold_count(name, silver) for name in _GOLD_COLUMNS}
    values = {
        "bronze_ingestion_row_count": bronze,
        "bronze_ingestion_column_count": "13",
        "silver_transformation_row_count": kept,
        "silver_transformation_row_count_input": bronze,
        "silver_transformation_row_count_output": kept,
        "silver_transformation_retention_percentage": f"{kept} / {bronze} * 100",
        "silver_transformation_duplicates_removed": f"(select count(*) from {keyed}) - {kept}",
        "silver_transformation_column_count": "18",
        "gold_metrics_generation_total_rows": " + ".join(gold.values()),
        "gold_metrics_generation_num_tables": "6",
        **{f"gold_metrics_generation_{name}": count for name, count in gold.items()},
        "run_errors": "0",
    }
    return "\nunion all ".join(
        f"select cast({run_seq} as integer) as run_seq, '{key}' as metric_key, cast({value} as double) as value, "
        f"'SUCCESS' as status"
        for key, value in values.items()
    )


_CTES["run_metrics"] = (
    _run_metric_rows(1, "first_load", "first_keyed", "first_silver")
    + "\nunion all "
    + _run_metric_rows(2, "raw", "keyed", "silver")
)
_REPORT_KEYS = (
    "bronze_ingestion_row_count", "silver_transformation_row_count_output", "gold_metrics_generation_total_rows",
    "gold_metrics_generation_num_tables",
)


def _artifact_rows(run_seq: int, raw: str, silver: str) -> str:
    records = ",".join(_RECORD_COLUMNS)
    tables = [
        ("bronze", "claims", f"(select count(*) from {raw})", f"{records},_ingested_at,_record_id,_ingested_from,_source_name"),
        (
            "silver", "claims", f"(select count(*) from {silver})",
            ",".join(_SILVER_COLUMNS) + ",_transformed_at,_transformation_version",
        ),
        *[("gold", name, _gold_count(name, silver), columns) for name, columns in _GOLD_COLUMNS.items()],
    ]
    return "\nunion all ".join(
        f"select cast({run_seq} as integer) as run_seq, '{layer}' as layer, '{name}' as name, "
        f"cast({count} as bigint) as row_count, cast({len(columns.split(','))} as integer) as column_count, "
        f"'{columns}' as columns"
        for layer, name, count, columns in tables
    )


_INSURED = "select policy_id from customers where customer_income > 0 and policy_id is not null"


def _share(column: str) -> str:
    return f"""select {column}, count(*) as row_count,
        round_even(count(*) / (select count(*) from silver) * 100, 1) as percent
        from silver group by {column}"""


ORACLE: dict[str, str] = {
    "bronze_csv_scan": "select * replace (nullif(claim_amount, 'n/a') as claim_amount) from records",
    "bronze_csv_typed": """select * replace (
            cast(try_cast(replace(claim_amount, ',', '') as decimal(10,2)) as double) as claim_amount,
            cast(try_strptime(submitted_date, '%Y-%m-%d') as date) as submitted_date,
            cast(try_strptime(resolution_date, '%Y-%m-%d') as date) as resolution_date)
        from records""",
    "bronze_customers_csv": "select * from customers",
    "bronze_json_scan": "select * from notes",
    "bronze_notes": "select * from notes",
    "bronze_metadata": f"""select claim_id, policy_id, 'orders' as _ingested_from, 'claims_csv' as _source_name,
            sha256({_MARKED}) as _record_id
        from raw""",
    "bronze_gate": "select count(*) as row_count, cast(0 as bigint) as all_null_columns, count(*) > 0 as passed from records",
    "bronze_null_profile": "\nunion all ".join(
        f"select '{c}' as column_name, count(*) as row_count, count(*) - count({c}) as null_count, "
        f"count({c}) = 0 as all_null from records"
        for c in _RECORD_COLUMNS
    ),
    "bronze_write_readback": "select *, 'orders' as _ingested_from, 'claims_csv' as _source_name from records",
    "bronze_schema_merge": """select _record_id, claim_id,
            if(_ingested_at > timestamp '2025-01-01 00:00:00', status, null) as status,
            if(_ingested_at > timestamp '2025-01-01 00:00:00', resolution_date, null) as resolution_date,
            cast(if(_ingested_at > timestamp '2025-01-01 00:00:00', 2, 1) as integer) as load
        from raw""",
    "table_as_of_run": """select cast(1 as integer) as as_of_run, status, count(claim_id) as num_claims
            from first_silver group by status
        union all select cast(2 as integer), status, count(claim_id) from silver group by status""",
    "clean_amount": f"select _record_id, claim_amount, {_read_amount('claim_amount')} as claim_amount_clean from raw",
    "clean_date": f"""select _record_id, submitted_date, {_read_date("submitted_date")} as submitted_date_clean,
        resolution_date, {_read_date("resolution_date")} as resolution_date_clean from raw""",
    "clean_status": f"select _record_id, status, {_read_word('status', V.STATUS_WORDS)} as status_clean from raw",
    "clean_claim_type": f"""select _record_id, claim_type,
        {_read_word("claim_type", V.CLAIM_TYPE_WORDS)} as claim_type_clean from raw""",
    "amount_category": f"""select _record_id, claim_amount, {_category("claim_amount")} as category
        from (select _record_id, {_read_amount("claim_amount")} as claim_amount from raw)""",
    "days_to_resolution": f"""select _record_id, {_days("s", "r")} as days from (
        select _record_id, {_read_date("submitted_date")} as s, {_read_date("resolution_date")} as r from raw)""",
    "date_parts": f"""select _record_id, {_parts("d")}
        from (select _record_id, {_read_date("submitted_date")} as d from raw)""",
    "mask_ssn": """select customer_id, case when length(trim(customer_ssn)) >= 4
        then 'XXX-XX-' || right(trim(customer_ssn), 4) else 'MASKED' end as masked from customers""",
    "mask_address": """select customer_id, case when length(trim(customer_address)) > 0
        then 'MASKED_' || list_last(string_split(trim(customer_address), ' ')) else 'MASKED' end as masked
        from customers""",
    "clean_email": """select customer_id, customer_email,
        case when contains(customer_email, '@') and contains(customer_email, '.')
        then lower(trim(customer_email)) end as customer_email_clean from customers""",
    "clean_phone": """select customer_id, customer_phone,
        case when length(regexp_replace(customer_phone, '[^0-9+]', '', 'g')) >= 10
        then regexp_replace(customer_phone, '[^0-9+]', '', 'g') end as customer_phone_clean from customers""",
    "silver_standardize": "select * exclude (_ingested_at) from raw",
    "drop_null_keys": "select _record_id, claim_id, policy_id, submitted_date from keyed",
    "fill_defaults": """select _record_id, coalesce(claim_amount, '0.0') as claim_amount,
        coalesce(status, 'unknown') as status, coalesce(description, 'NO_DESCRIPTION') as description from raw""",
    "silver_normalize": "select * exclude (_ingested_at) from cleaned",
    "silver_features": f"""select * exclude (_ingested_at, customer_name, description)
        from ({_featured("cleaned")})""",
    "silver_dedupe": "select * exclude (_ingested_at) from latest",
    "silver_claims": "select *, '1.0' as _transformation_version from silver",
    "silver_customers": """select customer_id, policy_id, customer_name,
        case when contains(customer_email, '@') and contains(customer_email, '.')
            then lower(trim(customer_email)) end as customer_email,
        case when length(regexp_replace(customer_phone, '[^0-9+]', '', 'g')) >= 10
            then regexp_replace(customer_phone, '[^0-9+]', '', 'g') end as customer_phone,
        case when length(trim(customer_ssn)) >= 4 then 'XXX-XX-' || right(trim(customer_ssn), 4)
            else 'MASKED' end as customer_ssn,
        customer_income,
        case when length(trim(customer_address)) > 0
            then 'MASKED_' || list_last(string_split(trim(customer_address), ' ')) else 'MASKED' end
            as customer_address,
        signup_date
        from customers""",
    "silver_partitioned": "select claim_id, claim_amount, status, submitted_year, submitted_month from silver",
    "dq_row_retention": _RETENTION_ROWS,
    "dq_null_profile": _null_rows("records", _RECORD_COLUMNS),
    "dq_duplicates": _duplicate_rows("records"),
    "dq_allowed_values": _metric_rows(
        "value_distribution", "status", "records",
        ("actual_values", "count(distinct status)", "null", "'INFO'"),
        (
            "invalid_values", f"count(distinct status) filter (where status not in ({_ALLOWED}))", "0",
            f"if(count(*) filter (where status not in ({_ALLOWED})) = 0, 'PASS', 'FAIL')",
        ),
        ("invalid_count", f"count(*) filter (where status not in ({_ALLOWED}))", "null", "'INFO'"),
    ),
    "dq_allowed_table": _metric_rows(
        "value_distribution", "policy_id", "records",
        ("actual_values", "count(distinct policy_id)", "null", "'INFO'"),
        (
            "invalid_values", f"count(distinct policy_id) filter (where policy_id not in ({_INSURED}))", "0",
            f"if(count(*) filter (where policy_id not in ({_INSURED})) = 0, 'PASS', 'FAIL')",
        ),
        ("invalid_count", f"count(*) filter (where policy_id not in ({_INSURED}))", "null", "'INFO'"),
    ),
    "dq_outside_values": f"""select policy_id as value, count(*) as row_count from records
        where policy_id not in ({_INSURED}) group by policy_id""",
    "dq_distinct_over_runs": " union all ".join(
        f"select '{c}' as column_name, count(*) as row_count, count(distinct {c}) as exact_values, true as within_error from records"
        for c in ("claim_id", "policy_id", "claim_amount")
    ),
    "dq_value_table": f"""select status as value, count(*) as row_count, status in ({_ALLOWED}) as allowed
        from records where status is not null group by status""",
    "dq_row_duplicates": """select (select count(*) from records) as total_rows,
        (select count(*) from (select distinct * from records)) as distinct_rows,
        (select count(*) from records) - (select count(*) from (select distinct * from records)) as duplicate_rows""",
    "dq_report": f"""select *, if(max(status = 'FAIL') over (), 'FAIL', 'PASS') as overall_status
        from ({_SIZE_ROWS} union all {_null_rows("silver", _SILVER_COLUMNS)}
        union all {_duplicate_rows("silver")} union all {_RETENTION_ROWS})""",
    "gold_monthly_summary": _MONTHLY,
    "gold_status_breakdown": _STATUS,
    "gold_claim_type_analysis": _TYPES,
    "gold_high_value_claims": _HIGH_VALUE,
    "gold_resolution_time": _RESOLUTION,
    "gold_resolution_split": """select case when days_to_resolution is null then 'PENDING'
            when days_to_resolution <= 7 then '0-7_DAYS' when days_to_resolution <= 30 then '8-30_DAYS'
            else '30+_DAYS' end as resolution_bucket, count(claim_id) as num_claims
        from silver group by 1""",
    "gold_fraud_features": _FRAUD,
    "gold_table_summary": _GOLD_SUMMARY,
    "gold_export_csv": _FRAUD,
    "run_phase_metrics": "select * from run_metrics",
    "run_summary": """select distinct run_seq, cast(3 as bigint) as phases, cast(0 as bigint) as failed_phases,
        'SUCCESS' as final_status, true as timed from run_metrics""",
    "run_params": f"""select run_seq, name, value from (select distinct run_seq from run_metrics),
        (values ('silver_transformation_version', '1.0'), ('final_status', 'SUCCESS'), ('silver_output_columns',
            '{",".join(_SILVER_COLUMNS)},_transformed_at,_transformation_version')) p(name, value)""",
    "run_failed_phases": """select * from (with gaps as (
            select * from raw where policy_id is null or submitted_date is null or status is null),
        kept as (select count(distinct claim_id) as n from gaps
            where policy_id is not null and submitted_date is not null)
        select cast(1 as integer) as run_seq, 'SILVER_TRANSFORMATION' as phase, 'FAILED' as status, n as row_count
            from kept where n < 0.9 * (select count(*) from gaps)
        union all select 2, 'BRONZE_INGESTION', 'FAILED', count(*) from gaps where claim_id = policy_id having count(*) = 0)""",
    "run_report": "select run_seq, 'SUCCESS' as status, '1.0' as silver_transformation_version, "
    + ", ".join(f"max(value) filter (where metric_key = '{key}') as {key}" for key in _REPORT_KEYS)
    + " from run_metrics group by run_seq",
    "run_quality": " union all ".join(
        f"""select cast({seq} as integer) as run_seq, 'QUALITY_{layer}' as phase, subject || '_' || metric as metric,
            cast(value as double) as value, status from ({rows}) where value is not null"""
        for seq, layer, rows in (
            (1, "BRONZE", f"{_RECORD_SIZE_ROWS} union all {_null_rows('records', _RECORD_COLUMNS)} "
                f"union all {_duplicate_rows('records')}"),
            (2, "SILVER", f"{_SIZE_ROWS} union all {_null_rows('silver', _SILVER_COLUMNS)} "
                f"union all {_duplicate_rows('silver')} union all {_RETENTION_ROWS}"),
        )
    ),
    "run_delta": """select run_seq, metric_key, value, previous_value, value - previous_value as delta,
            coalesce(value <> previous_value, false) as changed
        from (select *, lag(value) over (partition by metric_key order by run_seq) as previous_value
            from run_metrics)""",
    "run_alerts": """select * from (with months as (
            select submitted_year * 12 + submitted_month as run_seq, cast(count(*) as double) as row_count,
                max(claim_amount) as highest, count(*) filter (where status = 'unknown') * 16 >= count(*) as failed
            from silver where submitted_year is not null group by 1),
        metrics as (
            select run_seq, failed, 'silver_row_count' as metric_key, row_count as value, -1 as worse from months
            union all select run_seq, failed, 'silver_highest', highest, 0 from months),
        histories as (
            select *, coalesce(list(value) filter (where not failed) over (partition by metric_key order by run_seq
                rows between unbounded preceding and 1 preceding), []) as history from metrics),
        recents as (select *, history[greatest(len(history) - 11, 1):] as recent from histories),
        medians as (select *, cast(len(recent) as integer) as earlier_runs, list_median(recent) as median from recents),
        spreads as (
            select *, list_median(list_transform(recent, lambda x: abs(x - median))) * 1.4826 as spread from medians)
        select run_seq, metric_key, value, earlier_runs, round_even(median, 6) as median, round_even(spread, 6) as spread,
            earlier_runs >= 4 and coalesce(
                if(worse = 0, abs(value - median), (value - median) * worse) > 3 * spread, false) as alert
        from spreads)""",
    "run_throughput": """select cast(1 as integer) as run_seq, 'BRONZE_INGESTION' as phase, count(*) as row_count,
            true as measured from first_load
        union all select 1, 'SILVER_TRANSFORMATION', count(*), true from first_silver
        union all select 2, 'BRONZE_INGESTION', count(*), true from raw
        union all select 2, 'SILVER_TRANSFORMATION', count(*), true from silver""",
    "run_artifacts": _artifact_rows(1, "first_load", "first_silver")
    + "\nunion all "
    + _artifact_rows(2, "raw", "silver"),
    "value_counts": _share("status"),
    "category_counts": _share("claim_amount_category"),
    "amount_summary": f"""select count(*) as total_records, min(claim_amount) as min_amount,
        max(claim_amount) as max_amount, {_MEAN} as mean_amount from silver""",
    "top_claims": """select claim_id, claim_type, claim_amount, status from silver
        order by claim_amount desc, claim_id limit 5""",
    "monthly_resample": """select m.month, count(s.claim_id) as claim_count,
            coalesce(cast(sum(cast(s.claim_amount as decimal(18,2))) as double), 0.0) as total_amount
        from (select cast(unnest(generate_series(
                (select date_trunc('month', min(submitted_date)) from silver),
                (select date_trunc('month', max(submitted_date)) from silver), interval 1 month)) as date) as month) m
        left join silver s on cast(date_trunc('month', s.submitted_date) as date) = m.month
        group by m.month""",
    "amount_quantiles": "\nunion all ".join(
        f"select cast({p} as double) as probability, quantile_cont(claim_amount, {p}) as quantile from silver"
        for p in (0.5, 0.75, 0.95)
    ),
    "duplicate_flag": """select _record_id, claim_id,
        row_number() over (partition by claim_id order by _record_id) > 1 as is_duplicate from raw""",
}
# The same tables by other ways: records of several lines, loads merged one by one, counts kept up.
ORACLE |= {
    "bronze_json_array": ORACLE["bronze_json_scan"],
    "bronze_csv_multiline": """select * replace (
        if(customer_id like '%3', '"c/o"' || chr(10), '') || replace(customer_address, ', ', chr(10)) as customer_address)
        from customers""",
    "silver_upsert": ORACLE["silver_claims"],
    "kept_monthly_summary": ORACLE["gold_monthly_summary"],
    "kept_status_breakdown": ORACLE["gold_status_breakdown"],
    "kept_claim_type_analysis": ORACLE["gold_claim_type_analysis"],
    "kept_resolution_time": ORACLE["gold_resolution_time"],
}

ORACLE = {key: _sql(body) for key, body in ORACLE.items()}
