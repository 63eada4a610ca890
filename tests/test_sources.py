"""The text sink never touches its inputs; scans read back what was written."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from gapwright.functions import aggregates as A
from gapwright.functions import scalars as S
from gapwright.operators.shape import without_nan
from gapwright.plans.compiled import compile_units
from gapwright.sources import delimited
from tests.helpers import one_value, rows


@pytest.fixture
def table(make):
    return make("a string, b int", ("x", 1), (None, 2))


def test_output_may_not_overlap_an_input_however_it_is_spelled(table, tmp_path):
    source = tmp_path / "records" / "r.tsv"
    source.parent.mkdir()
    source.write_text("a\tb\nx\t1\n")
    other = tmp_path / "other"
    for out, inputs in [
        (str(source), [str(source)]),
        (str(source.parent), [str(source)]),
        (f"file:{source.parent}", [str(source)]),
        (f"file://{source.parent}/", [str(source)]),
        (f"{tmp_path}//records", [str(source)]),
        (os.path.relpath(source.parent), [str(source)]),
        (f"{tmp_path}/other/../records", [str(source)]),
        (str(source / "below"), [str(source)]),
        (str(source.parent), [str(other), [str(other), str(source)]]),
    ]:
        for overwrite in (False, True):
            with pytest.raises(ValueError, match="overlaps"):
                delimited.write_records(table, out, inputs, overwrite=overwrite)
    assert source.read_text() == "a\tb\nx\t1\n"
    # a name that only begins alike is another path
    delimited.write_records(table, f"{source.parent}2", [str(source)])


def test_an_existing_output_is_replaced_only_on_request(table, tmp_path, spark):
    out = str(tmp_path / "out")
    delimited.write_records(table, out)
    with pytest.raises(Exception, match="(?i)exists"):
        delimited.write_records(table, out)
    delimited.write_records(table, out, overwrite=True)
    back, _ = delimited.scan(spark, out, ["n/a"], codes="ci")
    assert rows(back, "a", "b") == rows(table)


@pytest.mark.parametrize(
    ("text", "number"),
    [("12d", None), ("3f", None), ("0x1A", None), ("1e3", 1000.0), (" 5. ", 5.0), (".5", 0.5), ("-Inf", float("-inf")), ("NaN", None), ("1_000", None), ("", None), ("+7", 7.0)],
)
def test_only_numbers_are_numbers(make, text, number):
    assert one_value(make("u int", (1,)), S.lenient_double(F.lit(text))) == number


@pytest.mark.parametrize(
    ("text", "sep", "label"),
    [("a|a", "|", "a"), ("a|b", "|", "mixed"), ("a.a", ".", "a"), ("a;", ";", "a"), ("a;a;", ";", "a"), (";", ";", ""), ("a;;", ";", "mixed")],
)
def test_lists_are_split_literally(make, text, sep, label):
    assert one_value(make("u int", (1,)), A.collapse_list(F.lit(text), sep)) == label


def test_nan_is_missing(make):
    df = make("a double, b string, c float", (float("nan"), "NaN", 1.0), (2.0, None, float("nan")))
    assert rows(without_nan(df)) == sorted([(None, "NaN", 1.0), (2.0, None, None)], key=repr)


def test_missing_keys_meet_in_the_compiled_table(make):
    sheet = make(
        "Sample_Name string, Library_ID string, Strandedness string, UDG_Treatment string, sexdet_bam string",
        ("S1", "L1", "double", "none", "b1"),
        ("S1", None, "double", "none", None),
    )
    endogenous = make("endorspy_library_id string, endorspy_endogenous_dna double", ("L1", 1.0), (None, 2.0))
    got = compile_units(sheet, endogenous=endogenous)
    assert rows(got, "Library_ID", "Endogenous") == sorted([("L1", 1.0), (None, 2.0)], key=repr)



def test_rows_are_numbered_over_files_and_splits(spark, tmp_path):
    for name, n in (("a", 500), ("b", 1), ("c", 0), ("d", 300)):
        lines = "".join(f"{name}{i}\t{'x' * (i % 37)}\n" + ("\n" if i % 50 == 0 else "") for i in range(n))
        (tmp_path / f"{name}.tsv").write_text("id\ttext\n" + lines)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700b")
    try:
        table, order = delimited.scan(spark, str(tmp_path))
        assert order == ["_file", "_line"] and table.select("id").rdd.getNumPartitions() > 10
        got = sorted((r._file.rpartition("/")[2], r._line, r.id) for r in table.collect())
        # numbers don't depend on which columns are read, nor on what follows
        thin = table.groupBy("_file").agg(F.max("_line").alias("last"), F.count_distinct("_line").alias("n"))
        assert sorted((r.last, r.n) for r in thin.collect()) == [(0, 1), (299, 300), (499, 500)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == sorted((f"{name}.tsv", i, f"{name}{i}") for name, n in (("a", 500), ("b", 1), ("d", 300)) for i in range(n))


def test_a_failed_write_leaves_the_old_output(table, tmp_path, spark):
    out = tmp_path / "out"
    delimited.write_records(table, str(out))
    failing = spark.range(0, 1000, 1, 4).select(
        F.col("id").cast("string").alias("a"), F.when(F.col("id") == 900, F.raise_error(F.lit("half way"))).cast("int").alias("b")
    )
    with pytest.raises(Exception, match="half way"):
        delimited.write_records(failing, str(out), overwrite=True)
    back, _ = delimited.scan(spark, str(out), ["n/a"], codes="ci")
    assert rows(back, "a", "b") == rows(table)
    with pytest.raises(Exception, match="half way"):
        delimited.write_records(failing, str(tmp_path / "new"))
    assert [p.name for p in tmp_path.iterdir()] == ["out"]  # nothing staged is left, nothing new is there
    delimited.write_records(table.limit(1), str(out), overwrite=True)
    assert delimited.scan(spark, str(out), ["n/a"])[0].count() == 1
    assert [p.name for p in tmp_path.iterdir()] == ["out"]


def test_pieces_of_a_file_are_numbered_through(spark, tmp_path):
    """The files of a folder are one file, in order of their names; a split of any of them has its place."""
    for folder, pieces in {"a": [40, 0, 25], "b": [7, 30]}.items():
        (tmp_path / folder).mkdir()
        at = 0
        for i, n in enumerate(pieces):
            (tmp_path / folder / f"part-{i:05d}.csv").write_text("k\tv\n" + "".join(f"{folder}\t{at + j}\n" for j in range(n)))
            at += n
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    try:
        table, order = delimited.scan(spark, [str(tmp_path / "a"), str(tmp_path / "b")], pieces=True)
        got = [(r["k"], int(r["v"]), r["_file"].rsplit("/", 1)[1], r["_line"]) for r in table.collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert order == ["_file", "_line"] and len(got) == 102
    assert all(k == folder and v == line for k, v, folder, line in got)


def test_a_part_of_a_text_table_is_not_sorted_in_one_task(spark, tmp_path):
    from gapwright.suite.queries import _text_files

    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        path = _text_files(spark, spark.range(4000).withColumnRenamed("id", "n"), F.col("n") % 2, ["n"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    files = spark.read.text(path).select("part", "_metadata.file_path").distinct().groupBy("part").count().collect()
    assert len(files) == 2 and all(r["count"] > 1 for r in files)
    table, _ = delimited.scan(spark, path, pieces=True)
    assert {int(r["n"]) - 2 * r["_line"] - int(r["part"]) for r in table.collect()} == {0}
