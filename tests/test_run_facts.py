"""Sheet and QC facts: hand-made edge rows, and a brute-force check on random rows."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F
from tests.helpers import rows

from gapwright.plans import presets as P
from gapwright.plans import run_facts, sheet

SHEET_SCHEMA = "o long, Sample_Name string, Library_ID string, Strandedness string, UDG_Treatment string, R1 string, BAM string"
STATS = ["Sample", *P.STATS_COLUMNS]
STATS_SCHEMA = "so long, Sample string, " + ", ".join(f"{c} double" for c in P.STATS_COLUMNS)


def stats_row(so, key, **values):
    return (so, key, *[None if values.get(c) is None else float(values[c]) for c in P.STATS_COLUMNS])


def facts(make, sheet_rows, stats_rows, **options):
    got = run_facts.import_run(
        make(SHEET_SCHEMA, *sheet_rows), make(STATS_SCHEMA, *stats_rows), ["o"], ["so"], with_means=True, **options
    )
    return {r["Sample_Name"]: r.asDict() for r in got.collect()}


def test_clean_sheet_collapses_lanes_and_recodes(make):
    df = make(
        SHEET_SCHEMA,
        (3, "S_1", "S_1.A0101.SG1", "double", "none", "lane1", None),
        (1, "S_1", "S_1.A0101.SG1", "double", "none", "lane2", None),
        (2, "S_1", "S_1.A0102.TF1", "single", None, None, "b"),
        (4, "S2", "X", None, "odd", "/p/ABC001.A0101.TF9.fq", None),
    )
    got = rows(sheet.clean_sheet(df, ["o"]))
    assert got == [
        ("S2", "X", "other", "mixed", "", "1240K", 4),
        ("S_1", "S_1.A0101.SG1", "ds", "minus", "S_1.A0101", "Shotgun", 1),
        ("S_1", "S_1.A0102.TF1", "ss", "mixed", "S_1.A0102", "1240K", 2),
    ]
    assert len(rows(sheet.clean_sheet(df, ["o"], "single"))) == 1
    with pytest.raises(ValueError, match="keep_only"):
        sheet.clean_sheet(df, ["o"], "both")


def test_summary(make):
    df = make(
        SHEET_SCHEMA,
        (2, "S1", "S1.B.TF1", "double", "half", None, None),
        (1, "S1", "S1.A.SG1", "single", "half", None, None),
        (3, "S2", "S2.A.XX1", "single", "none", None, None),
    )
    got = sheet.summarise_sheet(sheet.clean_sheet(df, ["o"]), ["o"])
    assert rows(got, "Sample_Name", "Nr_Libraries", "Capture_Type", "UDG", "Library_Built") == [
        ("S1", 2, "Shotgun;1240K", "half", "mixed"),
        ("S2", 1, "OtherCapture", "minus", "ss"),
    ]


def test_facets_edge_rows(make):
    lib = "double", "half", None, None
    got = facts(
        make,
        [
            (1, "S1", "S1.A.SG1", *lib), (2, "S1", "S1.B.TF1", *lib), (3, "S1", "S1.C.TF1", *lib), (4, "S1", "nodotSG1", *lib),
            (5, "S2", "S2.A.SG1", *lib), (6, "S2", "S2.B.SG1", *lib),
            (7, "S3", "S3.A.TF1", *lib),
            (8, None, "N.A.SG1", *lib),
        ],
        [
            # Sample row sorts first; its sex result wins although the library has one too.
            stats_row(1, "S1", sexdet_rate_x=0.8, sexdet_err_x=0.01, covered_snps=700),
            stats_row(2, "S1.A.SG1", sexdet_rate_x=0.4, sexdet_rate_y=0.05, endogenous_dna=0.3, damage_5p1=0.1,
                      x_contamination_snps=100, x_contamination=0.02, x_contamination_error=0.01, filtered_mapped_reads=10),
            # Below the cutoff: masked, but still listed.
            stats_row(3, "S1.B.TF1", x_contamination_snps=99, x_contamination=0.9, x_contamination_error=0.9, filtered_mapped_reads=1000, covered_snps=800),
            # No count: the value stays. Zero reads: no weight for damage.
            stats_row(4, "S1.C.TF1", x_contamination=0.08, x_contamination_error=0.04, filtered_mapped_reads=30, damage_5p1=0.3),
            # No dot: not part of the contamination facet.
            stats_row(5, "nodotSG1", x_contamination_snps=500, x_contamination=0.5, x_contamination_error=0.5, filtered_mapped_reads=50, endogenous_dna=0.1),
            # One Shotgun library lacks its QC row; a kept estimate lacks its weight.
            stats_row(6, "S2.A.SG1", endogenous_dna=0.2, x_contamination_snps=200, x_contamination=0.1, x_contamination_error=0.1),
            stats_row(7, "unknown", covered_snps=1),
            stats_row(8, None, covered_snps=1),
        ],
    )
    s1, s2, s3, unnamed = got["S1"], got["S2"], got["S3"], got[None]
    assert set(got) == {"S1", "S2", "S3", None}
    assert (s1["Genetic_Sex"], s1["Nr_SNPs"], s1["Endogenous"]) == ("F", 800.0, 0.3)
    assert s1["Sex_Determination_Note"] == "x-rate: 0.800 +- 0.010, y-rate: 0.050 +- NA"
    assert s1["contamination_mean"] == pytest.approx((0.02 * 10 + 0.08 * 30) / 40)
    assert (s1["Contamination"], s1["Contamination_Err"], s1["Contamination_Meas"]) == ("0.065", "0.033", "ANGSD")
    assert s1["Contamination_Note"].startswith("Nr Snps (per library): 100;99;NA. Estimate")
    assert s1["Contamination_Note"].endswith("fewer than 100 were excluded.")
    assert s1["Damage"] == pytest.approx((0.1 * 10 + 0.3 * 30) / 40)
    # Strict maximum, unknown weight, no sex result at all.
    assert (s2["Endogenous"], s2["Contamination"], s2["Contamination_Meas"], s2["Contamination_Note"]) == (None,) * 4
    assert (s2["Genetic_Sex"], s2["Nr_SNPs"], s2["Damage"]) == ("U", None, None)
    assert s2["Sex_Determination_Note"] == "x-rate: NA +- NA, y-rate: NA +- NA"
    assert (s3["Endogenous"], s3["Nr_Libraries"], s3["Capture_Type"]) == (None, 1, "1240K")
    assert (unnamed["Nr_Libraries"], unnamed["Nr_SNPs"]) == (1, None)


def test_a_key_that_names_a_sample_and_a_library_is_the_librarys(make):
    lib = "double", "half", None, None
    got = facts(
        make,
        [(1, "S1", "S1", *lib), (2, "S2", "S2.A.SG1", *lib), (3, "S3", "S2", *lib)],
        [stats_row(1, "S1", covered_snps=5, damage_5p1=0.5, filtered_mapped_reads=2), stats_row(2, "S2", covered_snps=7)],
    )
    assert [got[s]["Nr_SNPs"] for s in ("S1", "S2", "S3")] == [5.0, None, 7.0]
    assert got["S1"]["Damage"] == 0.5


def reference_facts(sheet_rows, stats_rows, cutoff):
    """The facets row by row, the long way."""
    libs = {}
    for o, sample, unit, build, treatment, r1, bam in sheet_rows:
        code = {"SG": "Shotgun", "TF": "1240K"}.get(unit[-3:-1], "OtherCapture")
        key = (sample, unit, {"single": "ss", "double": "ds"}.get(build, "other"), {"none": "minus", "half": "half", "full": "plus"}.get(treatment, "mixed"), code)
        libs[key] = min(o, libs.get(key, o))
    libs = sorted((o, *k) for k, o in libs.items())
    stats = [dict(zip(["so", *STATS], r)) for r in sorted(stats_rows)]
    units = {lib[2] for lib in libs}
    out = {}
    for sample in {lib[1] for lib in libs}:
        own = [lib for lib in libs if lib[1] == sample]
        joined = [(lib, s) for s in stats for lib in own if s["Sample"] == lib[2]]
        lone = [(lib, None) for lib in own if all(s["Sample"] != lib[2] for s in stats)]
        loose = [(None, s) for s in stats if s["Sample"] == sample and sample not in units]
        shot = [s and s["endogenous_dna"] for lib, s in joined + lone if lib[5] == "Shotgun"]
        named = [s for lib, s in joined + lone if "." in lib[2]]

        def mean(column, named=named):
            pairs = [(s[column], s["filtered_mapped_reads"]) for s in named if s and s[column] is not None
                     and not (s["x_contamination_snps"] is not None and s["x_contamination_snps"] < cutoff)]
            if not pairs or any(w is None for _, w in pairs) or sum(w for _, w in pairs) == 0:
                return None
            return sum(x * w for x, w in pairs) / sum(w for _, w in pairs)

        every = sorted([s for _, s in joined + loose], key=lambda s: s["so"])
        damage = [(s["damage_5p1"], s["filtered_mapped_reads"]) for s in every if s["damage_5p1"] is not None and s["filtered_mapped_reads"]]
        first = {c: next((s[c] for s in every if s[c] is not None), None) for c in ("sexdet_rate_x", "sexdet_rate_y")}
        snps = [s["covered_snps"] for s in every if s["covered_snps"] is not None]
        counts = ["NA" if not s or s["x_contamination_snps"] is None else str(int(s["x_contamination_snps"])) for s in named]
        out[sample] = {
            "Nr_Libraries": len(own), "Capture_Type": ";".join(lib[5] for lib in own),
            "UDG": own[0][4] if len({lib[4] for lib in own}) == 1 else "mixed",
            "Library_Built": own[0][3] if len({lib[3] for lib in own}) == 1 else "mixed",
            "Endogenous": max(shot) if shot and all(v is not None for v in shot) else None,
            "Damage": sum(x * w for x, w in damage) / sum(w for _, w in damage) if damage else None,
            "Nr_SNPs": max(snps) if snps else None, "mean": mean("x_contamination"), "err": mean("x_contamination_error"),
            "counts": ";".join(counts), "x": first["sexdet_rate_x"], "y": first["sexdet_rate_y"],
        }
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_rows_against_brute_force(make, seed):
    """One sample holds a third of the sheet, one key a third of the QC rows."""
    rng = random.Random(seed)
    sheet_rows, stats_rows = [], []
    for i in range(120):
        sample = "S0" if i % 3 == 0 else f"S{rng.randrange(12)}"
        dot = "." if rng.random() < 0.9 else ""
        unit = f"{sample}{dot}{rng.randrange(20)}.{rng.choice(['SG', 'TF', 'XX'])}1" if dot else f"{sample}u{rng.randrange(9)}SG1"
        sheet_rows.append((i, sample, unit, rng.choice(["single", "double", None]), rng.choice(["none", "half", "full", "odd", None]), None, None))
    keys = sorted({r[2] for r in sheet_rows} | {r[1] for r in sheet_rows} | {"nobody"})
    for i, so in enumerate(rng.sample(range(200_000), 90)):
        def maybe(choices):
            return rng.choice([None, *choices])
        key = keys[0] if i % 3 == 0 else rng.choice(keys)
        stats_rows.append(stats_row(so, key, sexdet_rate_x=maybe([0.4, 0.8]), sexdet_rate_y=maybe([0.05, 0.4]), endogenous_dna=rng.choice([0.25, 0.5, 0.125]),
                                    covered_snps=maybe([10, 20]), damage_5p1=maybe([0.5, 0.25]), x_contamination_snps=maybe([50, 100, 150]),
                                    x_contamination=maybe([0.5, 0.125]), x_contamination_error=maybe([0.25]), filtered_mapped_reads=rng.choice([0, 1, 2, 4, 8, None if seed == 3 else 16])))
    got = facts(make, sheet_rows, stats_rows)
    want = reference_facts(sheet_rows, stats_rows, 100)
    assert set(got) == set(want)
    for sample, w in want.items():
        g = got[sample]
        for column in ("Nr_Libraries", "Capture_Type", "UDG", "Library_Built", "Endogenous", "Nr_SNPs"):
            assert g[column] == w[column], (sample, column)
        for column, name in (("Damage", "Damage"), ("contamination_mean", "mean"), ("contamination_err_mean", "err")):
            assert g[column] == (None if w[name] is None else pytest.approx(w[name])), (sample, column)
        assert ("Nr Snps (per library): " + w["counts"] + "." in g["Contamination_Note"]) if w["mean"] is not None else g["Contamination_Note"] is None
        assert g["Sex_Determination_Note"].startswith("x-rate: " + ("NA" if w["x"] is None else "%.3f" % w["x"]))


def test_packages_together_equal_packages_apart(make):
    lib = "double", "half", None, None
    sheets = {p: make(SHEET_SCHEMA, (1, "S1", f"S1.{p}.SG1", *lib), (2, "S2", f"S2.{p}.TF1", *lib)) for p in "ab"}
    stats = {p: make(STATS_SCHEMA, stats_row(1, "S1", covered_snps=n), stats_row(2, f"S1.{p}.SG1", endogenous_dna=n / 8)) for n, p in enumerate("ab", 1)}
    tag = {p: (sheets[p].withColumn("package", F.lit(p)), stats[p].withColumn("package", F.lit(p))) for p in "ab"}
    both = [tag["a"][i].unionByName(tag["b"][i]) for i in (0, 1)]
    whole = run_facts.import_run(*both, ["o"], ["so"], scope=["package"])
    apart = [run_facts.import_run(*tag[p], ["o"], ["so"], scope=["package"]) for p in "ab"]
    assert rows(whole) == sorted(rows(apart[0]) + rows(apart[1]), key=repr)
    single = run_facts.import_run(sheets["a"], stats["a"], ["o"], ["so"])
    assert rows(apart[0].drop("package")) == rows(single)


@pytest.mark.parametrize("most", [0, 9, 1000])
def test_frequent_names_take_a_plan_of_their_own(make, most):
    """However many names count as frequent, and whatever the samples share, the facts are those of small groups."""
    rng = random.Random(5)
    units = [*(f"S{i // 2}.{i}.{rng.choice(['SG', 'TF'])}1" for i in range(24)), "S3", "S5", "plainSG1", None]
    sheet_rows = []
    for i in range(90):
        sample = rng.choice(["S0", "S0", "S1", "S2", "S3", "S4", "S5", "S6", "S7", "S8", "", None])
        sheet_rows.append((i, sample, rng.choice(units), rng.choice(["single", "double"]), rng.choice(["none", "half", None]), None, None))
    stats_rows = []
    for so in rng.sample(range(1000), 110):
        def maybe(choices):
            return rng.choice([None, *choices])
        key = rng.choice([units[0], *units, *(f"S{i}" for i in range(10)), "nobody", "nobody", ""])
        stats_rows.append(stats_row(so, key, sexdet_rate_x=maybe([0.4, 0.8]), endogenous_dna=rng.choice([0.25, 0.5]), covered_snps=maybe([10, 20]), damage_5p1=maybe([0.5]),
                                    x_contamination_snps=maybe([50, 150]), x_contamination=0.5, x_contamination_error=0.25, filtered_mapped_reads=rng.choice([1, 2, 4])))
    want = facts(make, sheet_rows, stats_rows, groups="small")
    assert want["S3"]["Nr_Libraries"] and any(w["Contamination_Note"] for w in want.values())
    assert facts(make, sheet_rows, stats_rows, groups="any", most=most) == want
    if most != 9:
        return
    tag = F.lit("p").alias("package")
    both = make(SHEET_SCHEMA, *sheet_rows).select("*", tag), make(STATS_SCHEMA, *stats_rows).select("*", tag)
    scoped = run_facts.import_run(*both, ["o"], ["so"], scope=["package"], with_means=True, groups="any", most=most)
    assert {r["Sample_Name"]: r.asDict() for r in scoped.drop("package").collect()} == want
    libraries = sheet.clean_sheet(both[0], ["o"], scope=["package"])
    apart = run_facts.run_facts(libraries, both[1], ["o"], ["so"], 100, scope=["package"], with_means=True, groups="any", most=most)
    assert {r["Sample_Name"]: r.asDict() for r in apart.drop("package").collect()} == want


def test_names_are_counted_over_both_tables(make):
    lib = "double", "half", None, None
    libraries = make(SHEET_SCHEMA, (1, "S1", "S1.A.SG1", *lib), (2, "S1", "S1.B.SG1", *lib), (3, "S2", "S1.A.SG1", *lib))
    stats = make(STATS_SCHEMA, stats_row(1, "S1.A.SG1"), stats_row(2, "S1"), stats_row(3, "x"), stats_row(4, "x"), stats_row(5, "x"))

    def found(most):
        hashes = run_facts.frequent_names(libraries, stats, [], "Sample_Name", "Library_ID", "Sample", most)
        names = make("n string", *[(n,) for n in ("S1", "S2", "S1.A.SG1", "S1.B.SG1", "x")])
        return rows(names.withColumn("_hash", run_facts.name_hash([], "n")).join(hashes, "_hash"), "n", "_listed")

    assert found(2) == [("S1", 1), ("S1.A.SG1", 1), ("x", 0)]
    assert found(3) == []


def test_a_frequent_key_of_no_sheet_leaves_the_sheet_in_place(make, monkeypatch):
    """Only the frequent names are written, and their QC rows are left out."""
    lib = "double", "half", None, None
    written = []
    stored = run_facts.stored
    monkeypatch.setattr(run_facts, "stored", lambda df: written.append(df.columns) or stored(df))
    stats_rows = [stats_row(1, "S1.A.SG1", covered_snps=3), *[stats_row(i, "nobody", covered_snps=i) for i in range(2, 9)]]
    got = facts(make, [(1, "S1", "S1.A.SG1", *lib)], stats_rows, groups="any", most=3)
    assert got["S1"]["Nr_SNPs"] == 3
    assert written == [["_hash", "_listed"]]
