"""Scans, sinks, lineage and gates."""

import datetime as dt
import os
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from claimloom.operators import bronze
from claimloom.schemas import SCHEMAS, as_strings, required_columns, schema_for
from claimloom.sources import readers, scratch, writers

HEADER = ",".join(SCHEMAS["claims"].fieldNames())


def write(path, text):
    path.write_text(text, encoding="utf8")
    return str(path)


def test_schemas():
    assert len(SCHEMAS["claims"]) == len(SCHEMAS["customers"]) == 9 and len(SCHEMAS["claim_notes"]) == 7
    assert required_columns(SCHEMAS["claims"]) == ["claim_id", "policy_id", "submitted_date"]
    assert SCHEMAS["claims"]["claim_amount"].dataType.simpleString() == "decimal(10,2)"
    assert schema_for("customers")["customer_income"].dataType.simpleString() == "decimal(12,2)"
    with pytest.raises(KeyError, match="claim_notes"):
        schema_for("claimz")


def test_csv_bad_cells_become_null(spark, tmp_path):
    path = write(tmp_path / "c.csv", f'{HEADER}\nC1,P1,"A, ""B""",Auto,12.50,d,2025-01-15,,PENDING\nC2,P2,x,Home,oops,d,nope,,X\n')
    good, bad = readers.read_csv(spark, path, SCHEMAS["claims"]).orderBy("claim_id").collect()
    assert (good.customer_name, good.claim_amount, good.submitted_date) == ('A, "B"', Decimal("12.50"), dt.date(2025, 1, 15))
    assert (bad.claim_amount, bad.submitted_date, bad.status) == (None, None, "X")
    kept = readers.read_csv(spark, path, SCHEMAS["claims"], keep_corrupt=True).orderBy("claim_id").collect()
    assert kept[0]._corrupt_record is None and kept[1]._corrupt_record.startswith("C2,P2")
    dropped = readers.read_csv(spark, path, SCHEMAS["claims"], mode="DROPMALFORMED").collect()
    assert [r.claim_id for r in dropped] == ["C1"]
    with pytest.raises(ValueError):
        readers.read_csv(spark, path, SCHEMAS["claims"], mode="LAX")


def test_csv_delimiter_and_no_header(spark, tmp_path):
    path = write(tmp_path / "c.csv", "C1;P1;n;Auto;1;d;2025-01-15;;s\n")
    assert readers.read_csv(spark, path, SCHEMAS["claims"], header=False, delimiter=";").first().claim_id == "C1"


def test_missing_markers(spark, tmp_path):
    path = write(tmp_path / "c.csv", f'{HEADER}\nC1,NA,null,"",n/a,None,2025-01-15,NaN,ok\n')
    row = readers.missing_to_null(readers.read_csv(spark, path, as_strings(SCHEMAS["claims"]))).first()
    assert tuple(row) == ("C1", None, None, None, None, None, "2025-01-15", None, "ok")


NOTE = '{"claim_id":"C%d","note_id":"N%d","severity_level":%s,"note_date":"2025-01-15"}'


def test_json_lines_and_array(spark, tmp_path):
    lines = write(tmp_path / "n.json", "\n".join(NOTE % (i, i, i) for i in (1, 2, 3)))
    assert readers.read_json(spark, lines, SCHEMAS["claim_notes"]).count() == 3
    assert readers.read_json(spark, lines, SCHEMAS["claim_notes"], multi_line=True).count() == 1
    array = write(tmp_path / "a.json", "[\n" + ",\n".join(NOTE % (i, i, i) for i in (1, 2)) + "\n]")
    rows = readers.read_json(spark, array, SCHEMAS["claim_notes"], multi_line=True).collect()
    assert [(r.severity_level, r.note_date) for r in rows] == [(1, dt.date(2025, 1, 15)), (2, dt.date(2025, 1, 15))]


def test_json_parse_modes(spark, tmp_path):
    path = write(tmp_path / "n.json", NOTE % (1, 1, 1) + "\n{broken\n" + NOTE % (2, 2, '"x"'))
    loose = readers.read_json(spark, path, SCHEMAS["claim_notes"], keep_corrupt=True).collect()
    assert len(loose) == 3 and sum(r._corrupt_record is not None for r in loose) == 2
    assert readers.read_json(spark, path, SCHEMAS["claim_notes"], mode="DROPMALFORMED").collect()[0].note_id == "N1"
    with pytest.raises(Exception, match="MALFORMED|malformed|FAILFAST"):
        readers.read_json(spark, path, SCHEMAS["claim_notes"], mode="FAILFAST").collect()


def test_json_column(spark):
    df = spark.createDataFrame([('{"k": 7}',), ("{bad",), (None,)], "p STRING")
    assert [r.k for r in df.select(readers.parse_json(F.col("p"), "k INT")["k"].alias("k")).collect()] == [7, None, None]
    with pytest.raises(ValueError):
        readers.parse_json(F.col("p"), "k INT", mode="DROPMALFORMED")


def test_lineage(spark):
    df = spark.createDataFrame([("a", 1), (None, 2)], "id STRING, n INT").repartition(2)
    at = dt.datetime(2025, 1, 1, tzinfo=dt.timezone.utc)
    out = bronze.add_lineage(df, source_name="s", ingested_from="/in", ingested_at=at)
    assert out.columns[2:] == ["_ingested_at", "_ingested_from", "_source_name", "_record_id"]
    rows = out.collect()
    assert len({r._record_id for r in rows}) == 2 and {(r._ingested_from, r._source_name) for r in rows} == {("/in", "s")}
    keyed = [bronze.add_lineage(d, source_name="s", ingested_from="x", keys=["id", "n"]) for d in (df, df.coalesce(1))]
    assert len({frozenset(r._record_id for r in k.collect()) for k in keyed}) == 1


def test_lineage_names_each_file(spark, tmp_path):
    spark.range(4).repartition(2).write.parquet(str(tmp_path / "t"))
    stamped = bronze.add_lineage(spark.read.parquet(str(tmp_path / "t")), source_name="s")
    assert all(re.search(r"/t/part-.*parquet$", r._ingested_from) for r in stamped.collect())


def test_empty_load_is_refused_and_nothing_is_overwritten(spark, tmp_path):
    path, df = str(tmp_path / "b"), spark.createDataFrame([("a", None)], "id STRING, x STRING")
    counts = bronze.ingest(df, path, source_name="s", ingested_from="here")
    assert counts == {"row_count": 1, "column_count": 6, "all_null_columns": ["x"]}
    with pytest.raises(bronze.EmptySource):
        bronze.ingest(df.where("id = 'z'"), path, source_name="s", ingested_from="here")
    assert readers.read_table(spark, path).count() == 1


def test_gate_reports(spark):
    df = spark.createDataFrame([("a", None), ("b", None)], "id STRING, x STRING")
    assert tuple(bronze.gate(df).first()) == (2, 1, True)
    assert tuple(bronze.gate(df.limit(0)).first()) == (0, 0, False)


def test_partitioned_write(spark, tmp_path):
    path = str(tmp_path / "p")
    df = spark.range(1000).selectExpr("id", "if(id % 3 = 0, 2025, 2024) y", "cast(id % 12 as int) m")
    assert writers.write_partitioned(df, path, ["y", "m"])["row_count"] == 1000
    back = readers.read_table(spark, path)
    assert back.where("y = 2025").count() == 334
    plan = back.where("y = 2025 and m = 3")._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*y#", plan)


def test_runs_side_by_side(spark, tmp_path):
    path = str(tmp_path / "t")
    for run, rows in ((1, 3), (2, 5), (4, 0)):
        writers.write_run(spark.range(rows).withColumn("x", F.lit("v")), path, run)
    counts = {n: writers.read_as_of_run(spark, path, n).count() for n in (1, 2, 3)}
    assert counts == {1: 3, 2: 5, 3: 5}
    writers.write_run(spark.range(7).withColumn("x", F.lit("v")), path, 2)
    assert writers.read_as_of_run(spark, path, 2).count() == 7
    assert writers.read_as_of_run(spark, path, 1).count() == 3


def test_an_empty_run_hides_the_one_before(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.write_run(spark.range(3), path, 1)
    writers.write_run(spark.range(0), path, 2)
    assert writers.read_as_of_run(spark, path).count() == 0


def test_batches_with_new_columns(spark):
    old = spark.range(1).toDF("id")
    out = writers.append_batches(old, old.withColumn("x", F.lit(1)))
    assert [(r.id, r.x) for r in out.collect()] == [(0, None), (0, 1)]


def test_csv_export_keeps_texts(spark, tmp_path):
    path = str(tmp_path / "e")
    rows = [(" HOME ", 'say "hi", ok', 0.1), (None, "x", 1e300)]
    df = spark.createDataFrame(rows, "a STRING, b STRING, c DOUBLE")
    writers.export_csv(df, path)
    back = readers.read_csv(spark, path, df.schema)
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))


class FakeSession:
    """Only the settings a session would answer with."""

    def __init__(self, **settings):
        self.conf = self
        self.settings = {k.replace("_", "."): v for k, v in settings.items()}

    def get(self, name, default=None):
        return self.settings.get(name, default)


def test_scratch_uses_the_shared_folder():
    shared = FakeSession(spark_app_id="a1", spark_master="spark://host", spark_checkpoint_dir="hdfs://x/shared/")
    root = scratch.scratch_root(shared)
    assert root.startswith("hdfs://x/shared/claimloom-") and root == scratch.scratch_root(shared)
    assert scratch.scratch_path(shared, "t") != scratch.scratch_path(shared, "t")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch.scratch_root(FakeSession(spark_app_id="a2", spark_master="spark://host"))
    assert scratch.scratch_root(FakeSession(spark_app_id="a3", spark_master="local[2]"))


def test_scratch_can_be_cleared(spark):
    path = scratch.scratch_path(spark, "t")
    writers.write_table(spark.range(3), path)
    kept = dict(scratch._roots)
    scratch._roots[spark.conf.get("spark.app.id")] = path
    try:
        scratch.clear_scratch(spark)
        assert not os.path.exists(path)
    finally:
        scratch._roots.update(kept)


def test_as_of_reads_only_the_wanted_run(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.write_run(spark.range(3), path, 1)
    writers.write_run(spark.range(5).withColumn("x", F.lit("v")), path, 4)
    assert writers.runs_of(spark, path) == [1, 4]
    assert writers.read_as_of_run(spark, path, 0).count() == 0
    early = writers.read_as_of_run(spark, path, 3)
    assert early.count() == 3 and "x" not in early.columns
    assert not any("=4" in f for f in early.inputFiles())
    merged = writers.read_as_of_run(spark, path, 3, merge_schema=True)
    assert "x" in merged.columns and merged.count() == merged.where("x is null").count() == 3
    assert writers.sizes_mb(spark, [path])[path] > 0
