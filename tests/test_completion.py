from __future__ import annotations

import math
import os
import time

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import functions as F
from tests.helpers import rows

from gapwright.operators.calibrate import ONE_SIGMA, TWO_SIGMA, calibrate_dates
from gapwright.plans import completion, context
from gapwright.plans import presets as P
from gapwright.session import dropped, stored
from gapwright.sources import delimited


def write(path, *lines):
    path.write_text("\n".join("\t".join(map(str, line)) for line in lines) + "\n")
    return str(path)


@pytest.fixture
def lab(make):
    """individual -> site, with two extracts per individual behind it."""
    individuals = make(
        "`individual.Full_Individual_Id` string, `individual.Archaeological_ID` string, `individual.C14_Id` string, `individual.C14_Info` string,"
        " `individual.C14_Calibrated_From` int, `individual.C14_Calibrated_To` int, `individual.C14_Uncalibrated` int,"
        " `individual.C14_Uncalibrated_Variation` int, `individual.Site` int",
        ("ABC001", 'grave "7"', "LAB-1", "info", -200, -100, 2100, 20, 1),
        ("ABC002", "8", "", "info", -200, -100, 2100, 20, 1),
        ("ABC003", "9", "LAB-3", None, None, None, 700, 25, 2),
        ("ABC009", "x", None, None, None, None, None, None, 2),
    )
    sites = make(
        "`site.Id` int, `site.Name` string, `site.Country` string, `site.Locality` string, `site.Latitude` double, `site.Longitude` double",
        (1, "Hill", "Here", "", 50.0, 10.5), (2, "Vale", "There", "Town", -10.0, 20.0),
    )
    extracts = make("`extract.Individual` string, `extract.N` int", ("ABC001", 1), ("ABC001", 2), ("ABC003", 1))
    chain = [(sites, "individual.Site", "site.Id"), (extracts, "individual.Full_Individual_Id", "extract.Individual")]
    return individuals, chain


@pytest.fixture
def curve(make):
    """Identity curve, so that medians and regions are known in closed form."""
    points = [(name, y, float(y), 10.0) for name in (P.CURVE_NORTH, P.CURVE_SOUTH) for y in range(0, 4000)]
    return make("curve string, cal_bp int, c14_age double, c14_sigma double", *points)


def test_context(make, lab):
    ids = make("context_id string", ("ABC001",), ("ABC002",), ("nobody",))
    got = {r["context_id"]: r for r in context.import_context(*lab, ids).collect()}
    assert set(got) == {"ABC001", "ABC002"}
    a, b = got["ABC001"], got["ABC002"]
    assert (a["Collection_ID"], a["Site"], a["Country"], a["Location"], a["Latitude"]) == ("grave '7'", "Hill", "Here", None, 50.0)
    assert (a["Date_C14_Labnr"], a["Date_BC_AD_Start"], a["Date_BC_AD_Stop"], a["Date_Type"], a["Date_Note"]) == ("LAB-1", -200, -100, "C14", "info")
    # Without a lab number no date is trusted.
    assert [b[c] for c in ("Date_C14_Labnr", "Date_BC_AD_Start", "Date_BC_AD_Stop", "Date_Type", "Date_Note")] == [None] * 5
    assert a["Date_BC_AD_Median"] is None and a["Date_C14_Uncal_BP"] is None
    guarded = context.import_context(*lab, make("context_id string", ("nobody",)), require_rows=True)
    with pytest.raises(Exception, match="none of the requested"):
        guarded.collect()
    assert rows(context.import_context(*lab, ids, require_rows=True), "context_id") == [("ABC001",), ("ABC002",)]


def test_context_with_calibration(make, lab, curve):
    ids = make("context_id string", ("ABC001",), ("ABC002",), ("ABC003",))
    got = {r["context_id"]: r for r in context.import_context(*lab, ids, curve=curve, trust_uncalibrated=True).collect()}
    a, b, c = (got[f"ABC00{i}"] for i in (1, 2, 3))
    # The lab's calibrated years come first; the median only comes from calibration.
    assert (a["Date_BC_AD_Start"], a["Date_BC_AD_Median"], a["Date_C14_Uncal_BP"], a["Date_C14_Uncal_BP_Err"]) == (-200, 1950 - 2100, 2100, 20)
    assert (b["Date_BC_AD_Median"], b["Date_C14_Uncal_BP"]) == (None, None)
    assert (c["Date_BC_AD_Median"], c["Date_Type"], c["Date_Note"]) == (1250, "C14", P.DATE_NOTE_CALIBRATED)
    spread = math.hypot(25, 10)
    assert c["Date_BC_AD_Start"] == pytest.approx(1250 - 2 * spread, abs=1.5)
    assert c["Date_BC_AD_Stop"] == pytest.approx(1250 + 2 * spread, abs=1.5)
    with pytest.raises(ValueError, match="curve"):
        context.import_context(*lab, ids, trust_uncalibrated=True)


def test_calibration_needs_latitudes(make, lab, curve):
    individuals, chain = lab
    blank = [(chain[0][0].withColumn("`site.Latitude`".strip("`"), F.lit(None).cast("double")), *chain[0][1:])]
    ids = make("context_id string", ("ABC001",))
    # Two stages may fail at the same time, which Spark reports as one error of its own.
    with pytest.raises((PySparkException, Py4JJavaError), match="latitude|Multiple failures in stage"):
        context.import_context(individuals, blank, ids, curve=curve, trust_uncalibrated=True).collect()
    lenient = context.import_context(individuals, blank, ids, curve=curve, trust_uncalibrated=True, strict_latitude=False)
    assert lenient.collect()[0]["Date_BC_AD_Median"] is None


def test_calibration_against_brute_force(make):
    """A wiggly curve, every date by hand over the whole curve."""
    points = [(y, float(y + 15 * math.sin(y / 12)), 5.0 + y % 4) for y in range(0, 1500)]
    curve = make("curve string, cal_bp int, c14_age double, c14_sigma double", *[("c", *p) for p in points])
    asked = [(700, 12), (655, 30), (701, 12), (20, 25), (700, 12), (None, 5)]
    dates = make("age int, error int, curve string", *[(a, e, "c") for a, e in asked])
    got = {(r["age"], r["error"]): tuple(r)[3:] for r in calibrate_dates(dates, curve, "age", "error", "curve").collect()}
    assert len(got) == 5 and got[(None, 5)] == (None,) * 5
    for age, error in [a for a in asked if a[0] is not None]:
        density = {y: math.exp(-((age - c) ** 2) / (2 * (error**2 + s**2))) / math.sqrt(error**2 + s**2) for y, c, s in points}
        total = sum(density.values())
        mass, median = 0.0, None
        for y in sorted(density, reverse=True):
            mass += density[y] / total
            if mass >= 0.5:
                median = y
                break
        want = [1950 - median]
        for level in (ONE_SIGMA, TWO_SIGMA):
            mass, inside = 0.0, []
            for y in sorted(density, key=lambda y: (-density[y], y)):
                if mass >= level:
                    break
                inside.append(y)
                mass += density[y] / total
            want += [1950 - max(inside), 1950 - min(inside)]
        assert got[(age, error)] == tuple(want)


def test_context_ids_strip_the_suffix(make):
    records = make("Record_ID string", ("ABC001_ss",), ("ABC001",), ("ABC001",), (None,))
    assert rows(completion.context_ids(records, "Record_ID", "_ss")) == [("ABC001", "ABC001"), ("ABC001_ss", "ABC001")]
    assert rows(completion.context_ids(records, "Record_ID", "_s+", regex=True)) == [("ABC001", "ABC001"), ("ABC001_ss", "ABC001")]


def test_standardise_records(make):
    old = make(
        "Individual_ID string, No_of_Libraries string, Data_Type string, Nr_autosomal_SNPs string, Xcontam string, Xcontam_stderr string, Coverage_1240K string, Endogenous string",
        ("x", "12.7", "n/a", "many", "0.1", "n/a", "1.5", "0.2"),
    )
    got = completion.standardise_records(old)
    assert dict(got.dtypes)["Nr_Libraries"] == "int" and dict(got.dtypes)["Endogenous"] == "double"
    assert got.collect()[0].asDict() == {
        "Record_ID": "x", "Nr_Libraries": 12, "Capture_Type": None, "Nr_SNPs": None, "Contamination": "0.1", "Contamination_Err": None,
        "Coverage_on_Target_SNPs": 1.5, "Endogenous": 0.2, "Contamination_Meas": None, "Contamination_Note": None,
    }
    with pytest.raises(ValueError, match="not found"):
        completion.standardise_records(old.drop("Xcontam"))


def test_fill_records_checks_ploidy(make):
    with pytest.raises(ValueError, match="ploidy"):
        completion.fill_records(make("Record_ID string", ("x",)), make("Record_ID string", ("x",)), "triploid", [])


def test_scan_types_missing_and_order(spark, tmp_path):
    path = write(tmp_path / "t.tsv", ["a", "b", "c"], [" x ", "1", "0.5"], ["NA", "two", "N/A"], ["", "3.9", "2"], ['q"t', "4", "1e2"])
    df, order = delimited.scan(spark, path, ["", "NA", "N/A"], "cid")
    ordered = df.orderBy(*order).select("a", "b", "c")
    assert [tuple(r) for r in ordered.collect()] == [("x", 1, 0.5), (None, None, None), (None, 3, 2.0), ('q"t', 4, 100.0)]
    with pytest.raises(ValueError, match="type codes"):
        delimited.scan(spark, path, (), "ci")
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        delimited.scan(spark, str(tmp_path / "none.tsv"))


def test_row_order_of_a_file_in_many_splits(spark, tmp_path):
    path = write(tmp_path / "big.tsv", ["n"], *[[i] for i in range(5000)])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        df, order = delimited.scan(spark, path)
        assert df.rdd.getNumPartitions() > 4
        assert [r["n"] for r in df.orderBy(*order).collect()] == [str(i) for i in range(5000)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_sink(spark, make, tmp_path):
    df = make("id string, d double, i int", ("a\tb", 6e5, None), (None, 0.25, 3))
    out = str(tmp_path / "out")
    delimited.write_records(df, out)
    back = delimited.read_text_table(spark, out)
    assert rows(back) == [("a\tb", "600000", "n/a"), ("n/a", "0.25", "3")]
    with pytest.raises(ValueError, match="input path"):
        delimited.write_records(df, out + "/", [out])


def package_files(folder):
    """Sheet, QC table and records of one run as files."""
    names = dict(P.STATS_COLUMNS)
    folder.mkdir(parents=True, exist_ok=True)
    sheet_head = ["Sample_Name", "Library_ID", "Lane", "Colour", "SeqType", "Organism", "Strandedness", "UDG_Treatment", "R1", "R2", "BAM"]
    sheet = write(
        folder / "sheet.tsv",
        sheet_head,
        ["ABC001_ss", "ABC001.A0101.SG1", 1, 4, "PE", "H", "single", "none", "l1.fq", "NA", "NA"],
        ["ABC001_ss", "ABC001.A0101.SG1", 2, 4, "PE", "H", "single", "none", "l2.fq", "NA", "NA"],
        ["ABC003", "ABC003.A0101.TF1", 1, 4, "PE", "H", "double", "half", "l3.fq", "NA", "NA"],
        ["NEW001", "NEW001.A0101.TF1", 1, 4, "PE", "H", "double", "half", "l4.fq", "NA", "NA"],
    )

    def qc(key, **values):
        return [key, *[values.get(c, "N/A") for c in names]]

    stats = write(
        folder / "stats.tsv",
        ["Sample", *names.values()],
        qc("ABC001_ss", sexdet_rate_x=0.4, sexdet_rate_y=0.4, sexdet_err_x=0.01, sexdet_err_y=0.02, covered_snps=600000),
        qc("ABC001.A0101.SG1", endogenous_dna=45.5, damage_5p1=0.12, x_contamination_snps=250, x_contamination=0.0123, x_contamination_error=0.002, filtered_mapped_reads=1000),
        qc("ABC003.A0101.TF1", x_contamination_snps=20, x_contamination=0.5, x_contamination_error=0.2, filtered_mapped_reads=50),
    )
    records = write(
        folder / "records.tsv",
        ["Record_ID", "Site", "Nr_Libraries", "Genetic_Sex", "Relation_To", "Group_Name", "Unlisted"],
        ["ABC003", "kept", "n/a", "F", "n/a", "G", "u"],
        ["ABC001_ss", "n/a", "7", "U", "ABC003", "n/a", "u"],
        ["ABC999", "n/a", "n/a", "n/a", "n/a", "n/a", "u"],
    )
    return records, sheet, stats


def test_files_end_to_end(spark, make, tmp_path, lab):
    records, sheet, stats = package_files(tmp_path)
    out = str(tmp_path / "done")
    run = dict(output_path=out, ploidy="haploid", pipeline_url="https://example.org/p", suffix="_ss")
    counts = completion.complete_record_files(spark, records, sheet, stats, *lab, **run)
    # one unknown sex became M, one record had none and got none, the unlisted sample got U
    assert {k: counts[k] for k in ("rows", "unlisted", "unmatched", "repeated", "changed")} == {"rows": 4, "unlisted": 1, "unmatched": 0, "repeated": 0, "changed": 2}
    back = delimited.read_text_table(spark, out)
    got = {r["Record_ID"]: r.asDict() for r in back.collect()}
    assert "Unlisted" not in back.columns
    assert back.columns[:4] == ["Record_ID", "Collection_ID", "Relation_To", "Country"]
    a, c, other, new = got["ABC001_ss"], got["ABC003"], got["ABC999"], got["n/a"]
    assert (a["Site"], a["Country"], a["Collection_ID"], a["Date_BC_AD_Start"]) == ("Hill", "Here", "grave '7'", "-200")
    assert (a["Nr_Libraries"], a["Capture_Type"], a["UDG"], a["Library_Built"]) == ("7", "Shotgun", "minus", "ss")
    assert (a["Genetic_Sex"], a["Sex_Determination_Note"]) == ("M", "x-rate: 0.400 +- 0.010, y-rate: 0.400 +- 0.020")
    assert (a["Nr_SNPs"], a["Endogenous"], a["Damage"], a["Contamination"], a["Contamination_Meas"]) == ("600000", "45.5", "0.12", "0.012", "ANGSD")
    assert (a["Genotype_Ploidy"], a["Data_Preparation_Pipeline_URL"], a["Relation_To"]) == ("haploid", "https://example.org/p", "ABC003")
    # Filled cells stay; a masked estimate leaves nothing to fill in; the known sex keeps its (absent) note.
    assert (c["Site"], c["Nr_Libraries"], c["Contamination"], c["Genetic_Sex"], c["Sex_Determination_Note"]) == ("kept", "1", "n/a", "F", "n/a")
    assert (other["Site"], other["Genetic_Sex"], other["Group_Name"]) == ("n/a", "n/a", "n/a")
    assert (new["Nr_Libraries"], new["Genetic_Sex"]) == ("1", "U")
    # Record order, unlisted rows last.
    parts = sorted(f for f in os.listdir(out) if f.startswith("part"))
    lines = [line.split("\t")[0] for f in parts for line in open(os.path.join(out, f)).read().splitlines()]
    assert [x for x in lines if x != "Record_ID"] == ["ABC003", "ABC001_ss", "ABC999", "n/a"]
    with pytest.raises(ValueError, match="input path"):
        completion.complete_record_files(spark, records, sheet, stats, *lab, **{**run, "output_path": records})


def cells(spark, path):
    table = delimited.read_text_table(spark, path)
    return sorted([tuple(sorted(r.asDict().items())) for r in table.drop(completion.PACKAGE).collect()])


@pytest.mark.parametrize("groups", ["small", "placed", "any"])
def test_packages_together_equal_each_apart(spark, tmp_path, lab, groups):
    """The same sample and library names in two packages, with other values."""
    run = dict(ploidy="haploid", suffix="_ss", run_options={"groups": groups})
    apart = []
    for name in ("one", "two"):
        paths = package_files(tmp_path / "in" / name)
        if name == "two":
            for path in paths:
                text = open(path).read()
                open(path, "w").write(text.replace("45.5", "12.25").replace("ABC999", "XYZ111").replace("half", "full").replace("600000", "700"))
        completion.complete_record_files(spark, *paths, *lab, output_path=str(tmp_path / f"out-{name}"), **run)
        apart.append(cells(spark, str(tmp_path / f"out-{name}")))
    assert apart[0] != apart[1]
    together = [str(tmp_path / "in" / "*" / f"{kind}.tsv") for kind in ("records", "sheet", "stats")]
    counts = completion.complete_record_files(spark, *together, *lab, output_path=str(tmp_path / "out"), packages=True, **run)
    assert counts["rows"] == 8 and counts["repeated"] == 0
    for name, expected in zip(("one", "two"), apart, strict=True):
        got = cells(spark, str(tmp_path / "out" / f"package={name}"))
        assert got == expected, [(a, b) for x, y in zip(got, expected, strict=False) for a, b in zip(x, y, strict=False) if a != b]


def test_counts_equal_the_report_of_changes(spark, make):
    from pyspark.sql import Observation

    from gapwright.operators import fill

    records = make("k string, sex string, n int", ("a", "U", None), ("b", "F", None), ("c", None, 1), ("d", "U", None), (None, "M", None))
    external = make("k string, sex string, note string, n int", ("a", "M", "x", 2), ("b", "M", "y", 3), ("c", "F", "z", 9), ("e", "U", "w", 4), ("d", "U", "v", None), ("d", "F", "u", 5))
    link, seen = fill.Linked("sex", "note", "U"), Observation("fill")
    done = fill.fill_missing(records, external, ["k"], ["n"], linked=link, unlisted="keep", keep_old="old", counted=True)
    counted = fill.observed_counts(done, seen)
    got = counted.collect()
    changes = fill.change_report(done, ["k"], "old", "sex").count()
    assert seen.get == {"rows": 7, "unlisted": 1, "unmatched": 1, "repeated": 2, "gained": 4, "changed": changes}
    assert len(got) == 7 and changes == 4


def test_an_empty_table_fails_in_the_job_that_reads_it(make):
    from gapwright.operators.shape import must_have_rows

    table = make("a string, b int", ("x", 1))
    assert rows(must_have_rows(table, "nothing here")) == [("x", 1)]
    with pytest.raises(Exception, match="nothing here"):
        must_have_rows(table.where("b > 5"), "nothing here").write.format("noop").mode("overwrite").save()


def test_a_stored_table_leaves_no_shuffle_files(spark):
    """The table is read without the files of the shuffle that made it, and goes with `dropped`."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        return {b.name() for b in map(files.getAllBlocks().apply, range(files.getAllBlocks().size())) if b.isShuffle()}

    before = shuffles()
    table = stored(spark.range(1000).repartition(5, "id").groupBy((F.col("id") % 7).alias("k")).count())
    until = time.time() + 20
    while shuffles() - before and time.time() < until:  # they go a moment after the job
        time.sleep(0.2)
    assert not shuffles() - before
    assert table.count() == 7
    folder = os.path.dirname(table.inputFiles()[0].removeprefix("file:").replace("///", "/"))
    dropped(table)
    assert not os.path.exists(folder)
