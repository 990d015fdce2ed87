"""Current rows in buckets, and counts kept up with what loads replace."""

import itertools
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from claimloom.operators import counts, gold, silver
from claimloom.plans import recipes
from claimloom.plans.catalog import RUN_TS
from claimloom.sources.state import Buckets


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.fixture(scope="module")
def raw(spark, sf_dir):
    return recipes.raw_claims(spark, sf_dir).cache()


@pytest.fixture(scope="module")
def loads(raw):
    part = F.when(F.col("_ingested_at") <= F.lit(recipes.FIRST_LOAD).cast("timestamp_ntz"), 0).otherwise(
        1 + F.pmod("_record_id", F.lit(4)).cast("int") % 2
    )
    return [raw.where(part == k) for k in range(3)]


def files(path):
    return {p: p.stat().st_mtime_ns for p in Path(path).rglob("part-*.parquet")}


def test_loads_in_any_order_equal_one_run(spark, raw, loads, tmp_path):
    want = rows(silver.transform_claims(raw, RUN_TS))
    for order in itertools.permutations(range(3)):
        state = Buckets(str(tmp_path / "".join(map(str, order))), "claim_id", silver.latest_claims, count=4)
        for k in (*order, order[0]):  # a load that comes again changes nothing
            state.merge(loads[k])
        assert rows(silver.clean_claims(state.read(spark), RUN_TS)) == want


def test_a_load_rewrites_only_its_buckets(spark, loads, tmp_path):
    state = Buckets(str(tmp_path), "claim_id", silver.latest_claims, count=64)
    state.merge(loads[0])
    before, where = files(tmp_path), state.current(spark)
    few = loads[1].where("claim_id is not null").orderBy("claim_id").limit(3)
    done = state.merge(few)
    assert 1 <= done["buckets"] <= 3 and done["generation"] == 2
    after, now = files(tmp_path), state.current(spark)
    assert before.items() <= after.items()
    moved = {b for b, n in now.items() if where.get(b) != n}
    assert len(moved) == done["buckets"] and all(now[b] == 2 for b in moved)
    assert rows(state.read(spark)) == rows(silver.latest_claims(loads[0].unionByName(few)))


def test_unfinished_merges_and_empty_loads_change_nothing(spark, loads, tmp_path):
    state = Buckets(str(tmp_path), "claim_id", silver.latest_claims, count=4)
    assert state.read(spark) is None and state.current(spark) == {}
    assert state.merge(loads[0].where("false")) == {"generation": 0, "buckets": 0, "rows": 0}
    state.merge(loads[0])
    want = rows(state.read(spark))
    state.merge(loads[1])
    (tmp_path / "_generation=2" / "_SUCCESS").unlink()  # as if the job had been ended before its last step
    assert rows(state.read(spark)) == want
    assert state.merge(loads[1])["generation"] == 3
    assert rows(state.read(spark)) == rows(silver.latest_claims(loads[0].unionByName(loads[1])))


def test_a_merge_and_its_changes_shuffle_claims_once(spark, loads, tmp_path):
    calls = []
    state = Buckets(str(tmp_path), "claim_id", lambda df: calls.append(1) or silver.latest_claims(df), count=4)
    state.merge(loads[0])
    state.merge(loads[1])
    assert len(calls) == 2
    other = loads[2].withColumn("status", F.lit(7)).drop("description")  # not the state's columns and types
    done = state.merge(other)
    every = loads[0].unionByName(loads[1]).unionByName(silver.standardize_columns(other))
    assert rows(state.read(spark)) == rows(silver.latest_claims(every))
    clean = [silver.clean_claims(x, RUN_TS) for x in state.changes(spark, done["generation"])]
    plan = counts.count_changes(*clean)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def rounded(df):
    return rows(df.select([F.bround(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]))


def test_kept_gold_tables_equal_a_new_computation_after_every_load(spark, loads, tmp_path):
    state = Buckets(str(tmp_path / "state"), "claim_id", silver.latest_claims, count=4)
    seen = None
    replaced = loads[0].where("claim_id is not null").limit(200).withColumns(
        {"_ingested_at": F.lit("2030-01-01").cast("timestamp_ntz"), "claim_amount": F.lit("123.45"), "status": F.lit("denied")}
    )
    for load in (loads[1], loads[0], loads[2], replaced):
        done = state.merge(load)
        before, after = state.changes(spark, done["generation"])
        clean = [None if x is None else silver.clean_claims(x, RUN_TS) for x in (before, after)]
        counts.record_changes(*clean, str(tmp_path / "counts"), done["generation"])
        seen = load if seen is None else seen.unionByName(load)
        kept = counts.read_counts(spark, str(tmp_path / "counts"))
        assert kept.where(f"{counts.COUNT} < 0").isEmpty()
        whole = silver.transform_claims(seen, RUN_TS).cache()
        for name, build in counts.KEPT_TABLES.items():
            assert rounded(build(kept)) == rounded(gold.GOLD_TABLES[name](whole)), name
    early = counts.read_counts(spark, str(tmp_path / "counts"), 1)
    assert rows(early) == rows(counts.claim_counts(silver.transform_claims(loads[1], RUN_TS)))


def test_equal_amounts_have_no_spread_and_the_least_and_largest_go_with_their_claims(spark, make_silver):
    first = make_silver([(10_000.01, 3, "auto", "pending")] * 3 + [(99_999.0, 3, "auto", "approved"), (10_000.0, None, "auto", "denied")])
    later = make_silver([(10_000.01, 3, "auto", "pending")] * 3)
    kept = counts.summed(counts.claim_counts(first).unionByName(counts.count_changes(first, later)))
    (row,) = gold.monthly_summary(kept, weight=counts.COUNT).collect()
    assert (row.num_claims, row.min_claim_amount, row.max_claim_amount, row.std_claim_amount) == (3, 10_000.01, 10_000.01, 0.0)
    assert (row.approved_count, row.total_claim_amount, row.median_days_to_resolution) == (0, 30_000.03, 3)
    with pytest.raises(FileNotFoundError):
        counts.read_counts(spark, "/nowhere/at/all")
