"""Records of several lines: read by many splits like by one task."""

import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimloom.sources import readers, records
from claimloom.sources.records import split_lines

NOTE = (
    T.StructType()
    .add("id", "long")
    .add("text", "string")
    .add("tags", T.ArrayType(T.StringType()))
    .add("at", T.StructType().add("x", "double"))
)


@pytest.fixture
def small_splits(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "150")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def notes(n, seed=3):
    draw = random.Random(seed)
    texts = ["plain", 'a "quoted" [bracket', "back\\slash }{ ]]", "line\nbreak", "é漢", "", "\\\\", '\\"', "x" * 400]
    return [
        {"id": i, "text": draw.choice(texts), "tags": draw.sample(texts, draw.randint(0, 3)), "at": {"x": i / 4}} for i in range(n)
    ]


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize(
    "layout",
    [
        {"indent": 2}, {"indent": 4, "ensure_ascii": False}, {}, {"indent": 0}, {"separators": (",\n", ":")},
        {"separators": (" ,", ":\n")},
    ],
)
def test_arrays_of_many_splits_equal_the_whole_file(spark, tmp_path, small_splits, layout):
    (tmp_path / "a.json").write_text(json.dumps(notes(60), **layout))
    (tmp_path / "b.json").write_text("\n\n " + json.dumps(notes(7, 9), **layout) + "\n")
    (tmp_path / "c.json").write_text("[]")
    (tmp_path / "d.json").write_text("")
    (tmp_path / "e.json").write_text(json.dumps({"id": 77, "text": "alone"}, **layout))
    whole = readers.read_json(spark, str(tmp_path), NOTE, multi_line=True)
    split = readers.read_json_array(spark, str(tmp_path), NOTE)
    assert split.columns == whole.columns
    assert rows(split) == rows(whole) and split.count() == 68
    if layout == {"indent": 2}:
        assert split_lines(spark, str(tmp_path)).select("file", "block").distinct().count() > 30


BROKEN = [
    '{\n    "id": 1,\n    "text": oops\n  }', '{\n    "id": 1,\n    "tags": [\n      "a"\n  }', '{\n    "id": 1,\n    "text": "x"\n',
    '}', '{\n    "id": "no number"\n  }',
]


@pytest.mark.parametrize("broken", BROKEN)
def test_a_broken_element_costs_only_itself(spark, tmp_path, small_splits, broken):
    elements = [json.dumps(n, indent=2).replace("\n", "\n  ") for n in notes(12)]
    elements[5] = broken
    (tmp_path / "a.json").write_text("[\n  " + ",\n  ".join(elements) + "\n]\n")
    kept = readers.read_json_array(spark, str(tmp_path), NOTE, mode="DROPMALFORMED")
    assert sorted(r.id for r in kept.collect()) == [0, 1, 2, 3, 4, 6, 7, 8, 9, 10, 11]
    told = readers.read_json_array(spark, str(tmp_path), NOTE, keep_corrupt=True).where("_corrupt_record is not null").collect()
    assert len(told) == 1 and told[0]._corrupt_record.startswith(broken[:12])
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.read_json_array(spark, str(tmp_path), NOTE, mode="FAILFAST").collect()


CELLS = ["plain", "", "a,b", 'say "hi"', '"', '""', "two\nlines", "\n", "x\n\n\ny", '",\n"', "é", " padded ", "5\" pipe", "z" * 300]
PERSON = T.StructType().add("a", "string").add("b", "string").add("c", "integer")


def cell(value, draw):
    """As a writer would, or quoted without need."""
    if any(c in value for c in ',\n"') or value != value.strip() or draw.random() < 0.2:
        return '"' + value.replace('"', '""') + '"'
    return value


@pytest.mark.parametrize("seed", range(2))
def test_csv_with_line_breaks_of_many_splits_equals_the_whole_file(spark, tmp_path, small_splits, seed):
    draw = random.Random(seed)
    for name in "xy":
        lines = ["a,b,c"]
        for i in range(80):
            lines.append(f"{cell(draw.choice(CELLS), draw)},{cell(draw.choice(CELLS), draw)},{i}")
        (tmp_path / f"{name}.csv").write_text("\n".join(lines) + "\n" * draw.randint(0, 2))
    (tmp_path / "z.csv").write_text('a,b,c\n5" pipe,it"s,1\n"late",6" pipe,2\n"open,3\nclosed",y,4\n')
    whole = readers.read_csv(spark, str(tmp_path), PERSON, multi_line=True)
    split = readers.read_csv_records(spark, str(tmp_path), PERSON)
    assert rows(split) == rows(whole) and split.count() == 163
    assert split_lines(spark, str(tmp_path)).select("file", "block").distinct().count() > 30


def test_csv_modes_delimiters_and_line_ends(spark, tmp_path, small_splits):
    (tmp_path / "a.csv").write_bytes('1|"a\r\nb"|3\r\n2|x|oops\r\n\r\n3|"|"|4\r\n'.encode())
    schema = T.StructType().add("a", "integer", nullable=False).add("b", "string").add("c", "integer")
    read = lambda **k: readers.read_csv_records(spark, str(tmp_path), schema, header=False, delimiter="|", **k)
    assert rows(read()) == rows(readers.read_csv(spark, str(tmp_path), schema, header=False, delimiter="|", multi_line=True))
    assert sorted(r.a for r in read(mode="DROPMALFORMED").collect()) == [1, 3]
    assert [r._corrupt_record for r in read(keep_corrupt=True).where("a = 2").collect()] == ["2|x|oops"]
    with pytest.raises(Exception, match="(?i)malformed"):
        read(mode="FAILFAST").collect()


def test_a_record_longer_than_many_splits(spark, tmp_path, small_splits):
    long = "\n".join(f"line {i}" for i in range(2000))
    (tmp_path / "a.csv").write_text(f'a,b,c\n"{long}",x,1\nshort,"{long}",2\n')
    got = {r.c: (r.a, r.b) for r in readers.read_csv_records(spark, str(tmp_path), PERSON).collect()}
    assert got == {1: (long, "x"), 2: ("short", long)}


def test_tasks_grow_with_what_lines_take_in_memory(spark, tmp_path, small_splits, monkeypatch):
    path = tmp_path / "notes.json"
    path.write_text(json.dumps(notes(20), indent=2))
    monkeypatch.setattr(records, "TASK_OCTETS", 1 << 11)
    lines = records.dealt(records.split_lines(spark, str(path)))
    tasks = lines.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"), F.count_distinct("block").alias("splits")).collect()
    assert len(tasks) > int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert sum(t.n for t in tasks) == lines.count() and max(t.splits for t in tasks) < 20
    assert rows(readers.read_json_array(spark, str(path), NOTE)) == rows(spark.createDataFrame(notes(20), NOTE))
