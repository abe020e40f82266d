import csv
import json
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lakeledger.functions import flatten_columns
from lakeledger.operators.flatten_json import csv_lines, find_leaves, flatten_records
from lakeledger.plans.json_to_csv import flatten_json, flatten_json_to_csv
from lakeledger.sources.csv import read_csv_records
from lakeledger.sources.json import read_json_records, read_json_typed

RUN = datetime(2026, 5, 11, 1, 2, 3)


def put(folder, files):
    Path(folder).mkdir(parents=True, exist_ok=True)
    for name, text in files.items():
        path = Path(folder, name)
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)
    return str(folder)


def cells(path):
    rows = []
    for file in sorted(Path(path).glob("*.csv")):
        with open(file, newline="") as handle:
            rows += list(csv.DictReader(handle))
    return rows


def test_whole_files(spark, tmp_path):
    source = put(
        tmp_path / "in",
        {
            "a.json": '[{"z":1,"a":{"b":{"c":2}},"l":[1,"x"]},{"z":2,"n":null}]',
            "b.JSON": '{"q":true,"a":{"d":1.5}}',
            "bad.json": '[{"z":9},{"z":',
            "deep/scalar.json": "7",
            "c.txt": "no json",
        },
    )
    (tmp_path / "in" / "x").mkdir()
    got = flatten_json_to_csv(spark, source, str(tmp_path / "out"), RUN)
    assert (got.status, got.files, got.rows, got.skipped) == ("OK", 4, 3, 2)
    assert got.columns == ("z", "a_b_c", "l", "n", "q", "a_d")
    assert got.path.endswith("combined_20260511T010203Z")
    rows = sorted(cells(got.path), key=lambda r: r["z"])
    assert rows[0] == {"z": "", "a_b_c": "", "l": "", "n": "", "q": "true", "a_d": "1.5"}
    assert rows[1] == {"z": "1", "a_b_c": "2", "l": '[1,"x"]', "n": "", "q": "", "a_d": ""}
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        flatten_json_to_csv(spark, source, str(tmp_path / "out"), RUN)


def test_sorted_order(spark, tmp_path):
    source = put(tmp_path / "in", {"a.json": '{"z":1,"a":{"c":2,"b":3}}'})
    records = read_json_records(spark, source)
    assert flatten_json(records, order="sorted").columns == ["a_b", "a_c", "z"]
    assert flatten_json(records, sep=".").columns == ["z", "a.c", "a.b"]


def test_first_seen_order_follows_files_and_records(spark, tmp_path):
    source = put(
        tmp_path / "in",
        {"2.json": '[{"n":1,"a":1}]', "1.json": '[{"c":1},{"b":1,"c":2},{"a":3,"b":4}]'},
    )
    assert flatten_json(read_json_records(spark, source)).columns == ["c", "b", "a", "n"]


def test_object_meets_scalar(spark, tmp_path):
    source = put(
        tmp_path / "in",
        {"a.json": '[{"a":"s"},{"a":{"b":1}},{"a":null},{"e":{}},{"o":{"p":1}}]'},
    )
    flat = flatten_json(read_json_records(spark, source))
    assert flat.columns == ["a", "a_b", "o_p"]
    assert sorted((tuple(r) for r in flat.collect()), key=str) == sorted(
        [("s", None, None), (None, "1", None), (None, None, None), (None, None, None),
         (None, None, "1")],
        key=str,
    )


def test_objects_nested_below_mixed_paths(spark, tmp_path):
    source = put(
        tmp_path / "in",
        {"a.json": '[{"a":1},{"a":{"b":"{\\"c\\":0}"}},{"a":{"b":{"c":{"d":2.0},"e":[{"z":1,"y":2}]}}}]'},
    )
    flat = flatten_json(read_json_records(spark, source))
    assert flat.columns == ["a", "a_b", "a_b_c_d", "a_b_e"]
    assert [tuple(r) for r in flat.collect()] == [
        ("1", None, None, None),
        (None, '{"c":0}', None, None),
        (None, None, "2.0", '[{"z":1,"y":2}]'),
    ]
    plan = flat._jdf.queryExecution().optimizedPlan().toString()
    # One parse of the text, one of each mixed path; not one per column.
    assert plan.count("from_json(StructField") == 3


def test_null_in_place_of_an_object_is_a_blank_column(spark, tmp_path):
    source = put(tmp_path / "in", {"a.json": '[{"a":null},{"a":{"b":1}}]'})
    assert flatten_json(read_json_records(spark, source)).columns == ["a", "a_b"]


def test_name_collision(spark, tmp_path):
    source = put(
        tmp_path / "in", {"a.json": '[{"a":{"b":1},"a_b":2},{"a":{"b":3}},{"a_b":4}]'}
    )
    records = read_json_records(spark, source)
    with pytest.raises(ValueError, match="collide"):
        flatten_json(records)
    last = flatten_json(records, on_collision="last")
    assert sorted(r["a_b"] for r in last.collect()) == ["2", "3", "4"]


def test_lines(spark, tmp_path):
    source = put(tmp_path / "in", {"r.jsonl": '{"a":1}\n{bad\n\n   \n{"a":2}\n'})
    got = flatten_json_to_csv(spark, source, str(tmp_path / "out"), RUN, lines=True)
    assert (got.status, got.rows, got.skipped, got.columns) == ("OK", 2, 1, ("a",))
    typed = read_json_typed(spark, source, "a bigint", lines=True)
    assert sorted(r["a"] for r in typed.collect()) == [1, 2]


def test_statuses(spark, tmp_path):
    nothing = put(tmp_path / "none", {"a.txt": "x"})
    assert flatten_json_to_csv(spark, nothing, str(tmp_path / "o"), RUN).status == "NO_FILES"
    bad = put(tmp_path / "bad", {"a.json": "[{"})
    got = flatten_json_to_csv(spark, bad, str(tmp_path / "o"), RUN)
    assert (got.status, got.skipped) == ("NO_RECORDS", 1)


def test_typed_reader_takes_objects_and_arrays(spark, tmp_path):
    source = put(
        tmp_path / "in", {"a.json": '[\n{"z":1},\n{"z":2}]', "b.json": '{"z":3}', "c.json": "[{"}
    )
    assert sorted(r["z"] for r in read_json_typed(spark, source, "z bigint").collect()) == [1, 2, 3]


def test_flatten_columns(spark):
    df = spark.range(1).select(
        F.struct(F.lit(1).alias("b"), F.struct(F.lit("x").alias("d")).alias("c")).alias("a"),
        F.array(F.lit(1), F.lit(2)).alias("l"),
    )
    assert flatten_columns(df).first().asDict() == {"a_b": 1, "a_c_d": "x", "l": "[1,2]"}
    twice = df.withColumn("a_b", F.lit(7))
    with pytest.raises(ValueError, match="a_b"):
        flatten_columns(twice)
    assert flatten_columns(twice, on_collision="last").first()["a_b"] == 7


SHAPES = {
    "mixed.json": '[{"a":1},{"a":{"b":"{\\"c\\":0}"}},{"a":{"b":{"c":{"d":2.0},"e":[{"z":1,"y":2}]}}},{"a":null},{"e":{}}]',
    "twice.json": '[{"p":{"q":1},"p_q":2},{"p":{"q":3}},{"p_q":4},{"p":{"q":5},"p_q":null},{"x":{"x":{"x":""}},"1:x":"é"}]',
    "odd.json": '[{"k\'s":1,"k\\"d":[ ],"":{"":2}},{"s":"{not an object}","t":" {\\"u\\":1}","n":1.50,"m":1e3},{"d":1,"d":2}]',
}


def test_both_plans_give_the_same_rows(spark, tmp_path):
    """An expression per column, or cells laid over the columns: every odd shape."""
    records = read_json_records(spark, put(tmp_path / "in", SHAPES))
    leaves = find_leaves(records)
    narrow, wide = (flatten_records(records, leaves, on_collision="last", narrow=n) for n in (1000, 0))
    assert narrow.columns == wide.columns
    assert sorted(map(repr, narrow.collect())) == sorted(map(repr, wide.collect()))


def test_wide_plan_has_no_expression_per_column(spark, tmp_path):
    def nodes(columns):
        source = put(tmp_path / str(columns), {"a.json": str([{f"k{i}": {"v": i}} for i in range(columns)]).replace("'", '"')})
        records = read_json_records(spark, source)
        header, lines = csv_lines(records, find_leaves(records))
        assert header.count(",") == columns - 1
        text = lines._jdf.queryExecution().optimizedPlan().toString()
        return text.count("lambda"), text.count("from_json")

    assert nodes(3) == nodes(400)


def test_single_csv(spark, tmp_path):
    """One file, in the order of the input, as Python's reader sees it; parts are written by several tasks."""
    rows = [{"n": i, "t": {"v": ["", 'a,"b"', "two\nlines", " blank "][i % 4]}, **({"o": None} if i % 3 else {})} for i in range(500)]
    files = {f"{k}.jsonl": "\n".join(json.dumps(r) for r in rows[k * 100 : k * 100 + 100]) for k in range(5)}
    source = put(tmp_path / "in", files)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = flatten_json_to_csv(spark, source, str(tmp_path / "out"), RUN, lines=True, single_file=True)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert got.path.endswith("combined_20260511T010203Z.csv") and Path(got.path).is_file()
    with open(got.path, newline="") as handle:
        found = list(csv.DictReader(handle))
    assert found == [{"n": str(r["n"]), "t_v": r["t"]["v"], "o": ""} for r in rows]
    assert [p.name for p in (tmp_path / "out").iterdir() if not p.name.startswith(".")] == [Path(got.path).name]
    with pytest.raises(FileExistsError):
        flatten_json_to_csv(spark, source, str(tmp_path / "out"), RUN, lines=True, single_file=True)


def test_single_csv_of_one_blank_column(spark, tmp_path):
    source = put(tmp_path / "in", {"a.json": '[{"a":null},{"a":"x"},{"a":""}]'})
    got = flatten_json_to_csv(spark, source, str(tmp_path / "out"), RUN, single_file=True)
    with open(got.path, newline="") as handle:
        assert [r["a"] for r in csv.DictReader(handle)] == ["", "x", ""]


def test_sparse_rows_hold_the_filled_cells(spark, tmp_path):
    source = put(
        tmp_path / "in",
        {"a.json": '{"k":1,"a":{"b":"x"},"n":null,"e":""}\n{"k":2,"own":{"m":[1]}}\n{"k":3,"a_b":"y"}\n{broken\n'},
    )
    records = read_json_records(spark, source, lines=True)
    found = flatten_json(records, on_collision="last", sparse=True)
    rows = sorted((r["cells"] for r in found.collect()), key=lambda c: c["k"])
    assert rows == [{"k": "1", "a_b": "x", "e": ""}, {"k": "2", "own_m": "[1]"}, {"k": "3", "a_b": "y"}]
    with pytest.raises(ValueError, match="collide"):
        flatten_json(records, sparse=True)


def test_columns_that_grow_with_the_records(spark, tmp_path):
    """Laid out, these cells would be 6,000 x 12,001."""
    path = str(tmp_path / "in")
    text = "concat('{\"key\":', id, ',\"k', id, '\":{\"name\":\"n\",\"place\":{\"nation\":', id % 25, '}}}')"
    spark.range(6000).selectExpr(f"{text} AS value").write.text(path)
    found = flatten_json(read_json_records(spark, path, lines=True), sparse=True)
    assert found.columns == ["cells"]
    cells = found.select(F.explode("cells").alias("name", "cell"))
    assert cells.count() == 18_000 and cells.select("name").distinct().count() == 12_001


def test_single_csv_is_read_in_splits(spark, tmp_path):
    """Records over several splits, line ends of all kinds, quotes and blank cells, as Spark's own reader gives them."""
    rows = [
        {"k": n, "a": ["", 'say "x", \nok', "a\r\nb\n\n", "l1\n" * 900, '"', "\n", None, " p "][n % 8], "b,c": "é" * (n % 5) or None}
        for n in range(400)
    ]
    source = put(tmp_path / "in", {"a.json": "\n".join(json.dumps(r) for r in rows)})
    result = flatten_json_to_csv(spark, source, str(tmp_path / "out"), RUN, lines=True, single_file=True)
    plain = spark.read.options(header="true", escape='"', multiLine="true").csv(result.path)
    name = "spark.sql.files.maxPartitionBytes"
    old = spark.conf.get(name)
    spark.conf.set(name, "1500")
    try:
        assert spark.read.text(result.path).rdd.getNumPartitions() > 50
        found = read_csv_records(spark, result.path, result.columns)
        got = sorted(map(tuple, found.collect()), key=str)
    finally:
        spark.conf.set(name, old)
    assert found.columns == plain.columns == ["k", "a", "b,c"]
    assert got == sorted(map(tuple, plain.collect()), key=str) and len(got) == 400
