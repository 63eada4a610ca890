from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from tests.helpers import rows

from gapwright.functions import aggregates as A
from gapwright.operators import fill, joins, lists, shape


def test_resolve_grain_falls_back_to_the_own_key(make):
    facts = make("key string, v int", ("S1", 1), ("S1.A", 2), ("S1.A", 3), ("other", 4), (None, 5))
    units = make("sample string, unit string", ("S1", "S1.A"), ("S1", "S1.B"), ("S2", "S1.A"), ("S3", None))
    got = joins.resolve_grain(facts, units, "key", "unit", "sample").select("sample", "unit", "v", "is_unit")
    assert rows(got) == sorted(
        [
            ("S1", "S1.A", 2, True), ("S1", "S1.A", 3, True), ("S2", "S1.A", 2, True), ("S2", "S1.A", 3, True),
            ("S1", "S1.B", None, True), ("S3", None, None, True), ("S1", None, 1, False), ("other", None, 4, False),
        ],
        key=repr,
    )


def test_merge_facets(make):
    a = make("k string, x int", ("a", 1), ("b", 2))
    b = make("k string, y int", ("b", 3), ("c", 4))
    assert rows(joins.merge_facets([a, b], ["k"])) == [("a", 1, None), ("b", 2, 3), ("c", None, 4)]
    c = make("k string, z string", ("a", "p"), (None, "q"))
    got = rows(joins.merge_facets([a, b, c], ["k"]))
    assert got == sorted([("a", 1, None, "p"), ("b", 2, 3, None), ("c", None, 4, None), (None, None, None, "q")], key=repr)


def test_two_tables_merge_like_facets(make):
    """Repeated and missing keys, under one key and two."""
    a = make("k string, l string, x int", ("a", "1", 1), ("a", "1", 2), ("b", None, 3), (None, None, 4), (None, "1", 5))
    b = make("k string, l string, y int", ("a", "1", 6), ("b", None, 7), ("b", None, 8), (None, None, 9), ("c", "2", 10))
    for keys in (["k", "l"], ["k"]):
        right = b if len(keys) == 2 else b.drop("l")
        assert rows(joins.merge_two(a, right, keys), "k", "l", "x", "y") == rows(joins.merge_facets([a, right], keys), "k", "l", "x", "y")


def test_replace_columns_matches_missing_keys(make):
    left = make("k string, a int, b int", ("x", 1, 10), (None, 2, 20))
    right = make("k string, b int", ("x", 11), (None, 21))
    assert rows(joins.replace_columns(left, right, ["k"])) == [("x", 1, 11), (None, 2, 21)]


def test_members(make):
    sheet = make("s string, l string", ("S1", "S1.A"), ("S1", None))
    stats = make("key string, v int", ("S1", 1), ("S1.A", 2), ("S9", 3), (None, 4))
    ids = joins.member_ids(sheet, "s", "l")
    assert rows(ids) == [("S1",), ("S1.A",)]
    assert rows(joins.keep_members(stats, "key", ids, "id")) == [("S1", 1), ("S1.A", 2)]


def test_fill_never_changes_filled_cells_and_keeps_order(make):
    records = make("o int, id string, a string, b double", (2, "x", None, 1.0), (1, "y", "old", None), (3, "z", None, None))
    external = make("id string, a string, b double, c int", ("y", "new", 5.0, 7), ("x", "ext", 9.0, 8), ("w", "only", 2.0, 9))
    done = fill.fill_missing(records, external, ["id"], ["a", "b"], {"p": "haploid"}, keep_extra=True)
    ordered = fill.in_record_order(done, ["o"], ["id"]).drop("o")
    assert [tuple(r) for r in ordered.collect()] == [
        ("y", "old", 5.0, "haploid", 7), ("x", "ext", 1.0, "haploid", 8), ("z", None, None, "haploid", None), (None, "only", 2.0, "haploid", 9),
    ]


@pytest.mark.parametrize("unlisted, tail", [("null_id", [(None, "e")]), ("keep", [("w", "e")]), ("drop", [])])
def test_rows_unknown_to_the_records(make, unlisted, tail):
    records = make("id string, a string", ("x", "r"))
    external = make("id string, a string", ("x", "q"), ("w", "e"))
    done = fill.drop_helpers(fill.fill_missing(records, external, ["id"], ["a"], unlisted=unlisted), ["id"])
    assert rows(done) == sorted([("x", "r"), *tail], key=repr)
    with pytest.raises(ValueError, match="unlisted"):
        fill.fill_missing(records, external, ["id"], ["a"], unlisted="other")


def test_fill_with_columns_on_one_side_only(make):
    records = make("id string, a string", ("x", None))
    external = make("id string, b int", ("x", 3))
    done = fill.drop_helpers(fill.fill_missing(records, external, ["id"], ["a", "b"]), ["id"])
    assert rows(done) == [("x", None, 3)]
    with pytest.raises(ValueError, match="either side: c"):
        fill.fill_missing(records, external, ["id"], ["c"])


def test_fill_takes_the_record_type(make):
    records = make("id string, t string, i int", ("x", None, None), ("y", "0.1", 4))
    external = make("id string, t double, i double", ("x", 600000.0, 3.0), ("y", 1.0, 1.0))
    done = fill.drop_helpers(fill.fill_missing(records, external, ["id"], ["t", "i"]), ["id"])
    assert dict(done.dtypes) == {"id": "string", "t": "string", "i": "int"}
    assert rows(done) == [("x", "600000", 3), ("y", "0.1", 4)]


def test_fill_over_several_keys_equals_filling_apart(make):
    records = make("p string, id string, a string", ("1", "x", None), ("2", "x", None), ("2", "y", "r"))
    external = make("p string, id string, a string", ("1", "x", "one"), ("2", "x", "two"), ("2", "y", "no"))
    whole = rows(fill.drop_helpers(fill.fill_missing(records, external, ["p", "id"], ["a"]), ["p", "id"]))
    apart = []
    for p in ("1", "2"):
        part = [df.filter(F.col("p") == p) for df in (records, external)]
        apart += rows(fill.drop_helpers(fill.fill_missing(*part, ["p", "id"], ["a"]), ["p", "id"]))
    assert whole == sorted(apart, key=repr) == [("1", "x", "one"), ("2", "x", "two"), ("2", "y", "r")]


def test_fill_is_idempotent(make):
    records = make("id string, a string", ("x", None), ("y", "r"))
    external = make("id string, a string", ("x", "e"), ("y", "q"))
    once = fill.drop_helpers(fill.fill_missing(records, external, ["id"], ["a"], unlisted="drop"), ["id"])
    twice = fill.drop_helpers(fill.fill_missing(once, external, ["id"], ["a"], unlisted="drop"), ["id"])
    assert rows(once) == rows(twice)


@pytest.mark.parametrize(
    "old, old_note, ext, ext_note, new, note",
    [
        ("U", "old", "F", "new", "F", "new"),
        ("U", "old", "U", "new", "U", "old"),
        ("U", None, "U", "new", "U", "new"),
        ("F", "old", "M", "new", "F", "old"),
        ("F", None, "M", "new", "F", None),
        ("U", "old", None, None, None, "n/a"),
        (None, "old", "F", "new", "F", "n/a"),
        (None, None, None, None, None, "n/a"),
    ],
)
def test_linked_fill(make, old, old_note, ext, ext_note, new, note):
    records = make("id string, sex string, note string", ("x", old, old_note))
    external = make("id string, sex string, note string", ("x", ext, ext_note))
    link = fill.Linked("sex", "note", "U")
    done = fill.fill_missing(records, external, ["id"], [], linked=link, keep_old="was")
    assert rows(done, "sex", "note", "was") == [(new, note, old)]
    changed = rows(fill.change_report(done, ["id"], "was", "sex"))
    assert changed == ([] if old == new else [("x", old, new)])


def test_duplicate_keys(make):
    df = make("k string, v int", ("a", 1), ("a", 2), ("b", 3), (None, 1), (None, 2))
    assert rows(fill.duplicate_keys(df, ["k"])) == [("a", 2), (None, 2)]
    with pytest.raises(ValueError, match="records: key"):
        fill.assert_unique(df, ["k"], "records")
    fill.assert_unique(df.filter("k = 'b'"), ["k"])


def test_upgrade_schema(make):
    old = make("Individual_ID string, n int", ("x", 1))
    upgraded = shape.upgrade_schema(old, "Individual_ID", "id", {"n": "count"}, {"note": "string"})
    assert upgraded.columns == ["id", "count", "note"]
    assert shape.upgrade_schema(upgraded, "Individual_ID", "id", {"n": "count"}, {}).columns == upgraded.columns
    with pytest.raises(ValueError, match="both"):
        shape.upgrade_schema(old.withColumn("id", F.lit(1)), "Individual_ID", "id", {}, {})
    with pytest.raises(ValueError, match="neither"):
        shape.upgrade_schema(old.drop("Individual_ID"), "Individual_ID", "id", {}, {})
    with pytest.raises(ValueError, match="not found: m"):
        shape.upgrade_schema(old, "Individual_ID", "id", {"m": "x"}, {})


def test_column_choices(make):
    df = make("`a.x` int, `a.y` int, b int, m_Method1_ML_estimate double", (1, 2, 3, 0.5))
    assert shape.with_prefix(df, "a.", "zz") == ["a.x", "a.y"]
    assert shape.one_matching(df, ".*_method1_ml_estimate") == "m_Method1_ML_estimate"
    with pytest.raises(ValueError, match="0 columns"):
        shape.one_matching(df, "q")
    assert shape.first_present(df, "post", "b") == "b"
    with pytest.raises(ValueError, match="none of"):
        shape.first_present(df, "post")
    assert shape.pick(df, {"x": "a.x"}).columns == ["x"]
    with pytest.raises(ValueError, match="not found: q"):
        shape.pick(df, {"x": "q"})
    assert shape.add_if_absent(df, {"b": "string", "c": "double"}).dtypes[-2:] == [("m_Method1_ML_estimate", "double"), ("c", "double")]
    assert shape.strip_prefix(df, "a.").columns[:2] == ["x", "y"]


def test_layout_drops_unlisted_columns_and_places_prefixed_ones(make):
    df = make("Relation_To string, z int, b int, a int, Relation_Note string", ("r", 0, 1, 2, "n"))
    assert shape.layout(df, ["a", "c", "b"], {"a": "Relation_"}).columns == ["a", "Relation_To", "Relation_Note", "b"]


def test_normalize_missing(make):
    df = make("s string, d double", ("NA", float("nan")), ("N/A", 1.0), ("n/a", None), ("", 2.0))
    got = rows(shape.normalize_missing(df, ["", "N/A", "NA"]))
    assert got == sorted([(None, None), (None, 1.0), ("n/a", None), (None, 2.0)], key=repr)


@pytest.mark.parametrize("groups", ["small", "placed", "any"])
def test_lists_of_groups_without_places(make, groups):
    """A third of all rows without a place, a third at one place; all three plans agree."""
    import random

    rng = random.Random(4)
    data = [(rng.choice("hhhab"), rng.choice([None, 7, rng.randrange(1000)]), rng.choice([None, "x", "y", f"v{i}"]), i) for i in range(900)]
    df = make("k string, o int, v string, u int", *data)
    got = lists.ordered_lists(
        df, ["k"], {"all": F.col("v"), "some": F.col("u").cast("string")}, ["o"], {"n": A.staged_count("n")},
        where={"some": F.col("u") % 2 == 0}, groups=groups, **({"chunk_rows": 16} if groups == "any" else {}),
    )
    for row in got.collect():
        mine = [(o is not None, o or 0, "NA" if v is None else v, u) for k, o, v, u in data if k == row.k]
        assert row.all == ";".join(v for _, _, v, _ in sorted(mine, key=lambda e: e[:3]))
        assert row.some == ";".join(str(u) for _, _, u in sorted((a, b, str(u)) for a, b, _, u in mine if u % 2 == 0))
        assert row.n == len(mine)


def test_chunks_are_bounded_by_rows(make, spark):
    df = spark.range(0, 5000, 1, 7).select(F.lit("hot").alias("k"), F.lit(None).cast("int").alias("o"), F.col("id"))
    chunked = lists.consecutive_chunks(df, ["k", "o", "id"], 64)
    sizes = [r["count"] for r in chunked.groupBy("_chunk").count().collect()]
    assert max(sizes) <= 64 and sum(sizes) == 5000
    ends = chunked.groupBy("_chunk").agg(F.min("id").alias("a"), F.max("id").alias("b")).orderBy("_chunk").collect()
    assert all(x.b < y.a for x, y in zip(ends, ends[1:]))
    with pytest.raises(ValueError, match="power of two"):
        lists.consecutive_chunks(df, ["k"], 100)


def test_no_row_holds_a_curve_and_its_bounds_are_those_of_all_points(spark):
    """Bins of 32 years hold their own points only, however long the curve; steps count within and between bins and spans."""
    from gapwright.operators.calibrate import curve_bins, curve_bounds

    ages = [float(a) for a in range(0, 40_000, 3) if not 5_000 < a < 5_444] + [400_000.0, 400_001.5]
    curves = {"A": ages, "B": [7.0]}
    rows = [(c, i, a, 5.0 + i % 3) for c, listed in curves.items() for i, a in enumerate(listed)]
    bins = curve_bins(spark.createDataFrame(rows, "curve string, cal_bp int, c14_age double, c14_sigma double"), 32)
    assert max(len(r["points"]) for r in bins.collect()) == 11
    got = {r["curve"]: (r["n"], r["finest"], r["widest"], r["low"], r["high"], r["gap"]) for r in curve_bounds(bins, 16).collect()}
    assert got == {"A": (len(ages), 5.0, 7.0, 0.0, 400_001.5, 400_000.0 - 39_999.0), "B": (1, 5.0, 5.0, 7.0, 7.0, 0.0)}
    some = spark.createDataFrame([r for r in rows if r[0] == "A" and r[2] < 20_000], "curve string, cal_bp int, c14_age double, c14_sigma double")
    assert [r["gap"] for r in curve_bounds(curve_bins(some, 32), 16).collect()] == [5_445.0 - 4_998.0]
