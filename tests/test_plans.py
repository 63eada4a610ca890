"""What the plans look like, and whole registered queries against the checking engine."""

from __future__ import annotations

import re
import sys
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F
from tests.helpers import final_plan, static_plan

sys.path.insert(0, str(Path(__file__).resolve().parent.parent / "tools"))

from check import compare, connect  # noqa: E402

from gapwright.operators.shape import quoted  # noqa: E402
from gapwright.plans import presets as P  # noqa: E402
from gapwright.plans import run_facts, sheet  # noqa: E402
from gapwright.suite.oracle import ORACLE  # noqa: E402
from gapwright.suite.queries import QUERIES  # noqa: E402
from gapwright.suite.views import view  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture
def large_tables(spark):
    """Plans as for tables that are too large to broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_its_sql(spark, name):
    ok, text = compare(spark, connect(SMALL), SMALL, name)
    assert ok, text


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_python_no_cross_join(spark, large_tables, name):
    plan = static_plan(QUERIES[name](spark, SMALL))
    # the guard of an empty context counts its rows: one number a task goes to one task
    single = "" if name == "chain_context_guarded" else r"|SinglePartition"
    assert not re.search(r"Python|CartesianProduct|BroadcastNestedLoop|BroadcastHash|coalesce\(1\)" + single, plan)


SKEWED = """sheet_summary concat_ordered concat_ordered_any run_import_any rollup_units_any concat_distinct_pairs wmean_na wmean_distinct max_strict count_distinct_null members
grain_resolve chain_context run_import collate linked_fill compile_units rollup_units calibrate_batch complete_records""".split()


@pytest.fixture(scope="module")
def skewed_dir(tmp_path_factory):
    """The small tables with a third of all lines in one order, a sixth on one part, a third of orders with one customer."""
    out = tmp_path_factory.mktemp("skewed")
    con = connect(SMALL)
    changed = {
        "lineitem": "* REPLACE (CASE WHEN l_suppkey % 3 = 0 THEN 7 ELSE l_orderkey END AS l_orderkey, CASE WHEN l_suppkey % 6 = 1 THEN 38 ELSE l_partkey END AS l_partkey)",
        "orders": "* REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 5 ELSE o_custkey END AS o_custkey)",
    }
    for table in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.execute(f"COPY (SELECT {changed.get(table, '*')} FROM {table}) TO '{out}/{table}.parquet' (FORMAT parquet)")
    return str(out)


@pytest.mark.parametrize("name", SKEWED)
def test_query_matches_its_sql_on_skewed_tables(spark, large_tables, skewed_dir, name):
    hot = duckdb.sql(f"SELECT count(*) FILTER (l_orderkey = 7) / count(*) FROM '{skewed_dir}/lineitem.parquet'").fetchall()[0][0]
    assert hot > 0.3
    ok, text = compare(spark, connect(skewed_dir), skewed_dir, name)
    assert ok, text


def exchanges(plan: str) -> list[str]:
    return [line for line in plan.splitlines() if re.search(r"(?<!Reused)(?<!Broadcast)Exchange (hash|range)", line) and "ReusedExchange" not in line]


def scans(plan: str, table: str) -> int:
    return sum("FileScan" in line and table in line for line in plan.splitlines())


def test_run_facts_of_small_groups_read_each_table_once(spark, large_tables):
    """Sheet and QC table: two scans; distinct libraries, QC states, libraries by name, samples: four shuffles."""
    plan = final_plan(QUERIES["run_import"](spark, SMALL))
    assert scans(plan, "lineitem") == 2
    assert len(exchanges(plan)) == 4


def test_collated_facts_are_worked_out_once(spark, large_tables):
    """Sheet and QC table: two scans, and not two for the facts and two for their keys."""
    plan = static_plan(QUERIES["collate"](spark, SMALL))
    assert scans(plan, "lineitem") == 2


def test_run_facts_of_any_groups_join_and_group_without_gathering(spark, large_tables):
    plan = final_plan(QUERIES["run_import_any"](spark, SMALL))
    # the clean sheet is a table; the QC table is read once for the numbers and once, thin, for the list of counts
    assert scans(plan, "lineitem") == 2
    assert "FullOuter" not in plan


def test_run_facts_of_any_groups_take_three_shuffles_without_frequent_names(spark, large_tables):
    """Distinct libraries, both tables by name, samples; names were counted before."""
    assert len(exchanges(final_plan(QUERIES["run_import_any"](spark, SMALL)))) == 3


def test_lists_of_small_groups_take_one_shuffle(spark, large_tables):
    assert len(exchanges(final_plan(QUERIES["concat_ordered"](spark, SMALL)))) == 1
    # distinct libraries, then samples
    assert len(exchanges(final_plan(QUERIES["sheet_summary"](spark, SMALL)))) == 2


def test_rollup_takes_few_more_shuffles_than_its_input(spark, large_tables):
    """Units come from a table: libraries, samples, and both sides of the join back."""
    assert len(exchanges(final_plan(QUERIES["rollup_units"](spark, SMALL)))) <= 4


def test_compile_moves_the_sheet_once_a_key_and_each_table_once(spark, large_tables):
    plan = static_plan(QUERIES["compile_units"](spark, SMALL))
    # sheet: BAM, library, sample; tables: BAM twice (once for the part without a key), four lists of libraries and
    # samples, parts of the damage mean; and three that make the tables: damage rows, SNP counts, and their list
    assert len(exchanges(plan)) <= 13


def test_dates_are_calibrated_where_they_lie(spark, large_tables):
    """Above the join with the curve, no unfolded point is shuffled: the next shuffle is that of the results."""
    plan = static_plan(QUERIES["calibrate_batch"](spark, SMALL)).splitlines()
    unfold = next(i for i, line in enumerate(plan) if "Generate explode(points" in line)
    above = [line for line in plan[:unfold] if "Exchange hash" in line]
    assert len(above) == 2 and all("_curve" in line or "_right_0" in line for line in above)


def test_facets_are_merged_without_a_shuffle_per_join(spark, large_tables):
    plan = static_plan(QUERIES["facet_merge"](spark, SMALL))
    assert "FullOuter" not in plan and plan.count("Union") == 1


def test_children_of_the_chain_are_not_read(spark):
    plan = static_plan(QUERIES["chain_context"](spark, SMALL))
    assert "lineitem" not in plan
    assert "orders" in plan and "region" in plan


def test_individuals_are_filtered_before_the_chain(spark, large_tables):
    plan = static_plan(QUERIES["chain_context"](spark, SMALL))
    assert plan.index("LeftSemi") > max(m.start() for m in re.finditer("LeftOuter", plan))


def test_parts_of_qc_rows_are_hash_aggregated(spark, large_tables):
    stats = view(spark, SMALL, "v_stats")
    plan = static_plan(run_facts.stats_parts(stats, ["stat_ord"], 100, key="sample_key"))
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan and "HashAggregate" in plan


def test_filter_and_columns_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "sheet")
    columns = ["Sample_Name", "Library_ID", "Strandedness", "UDG_Treatment", "R1", "BAM", "Extra"]
    spark.range(10).select(F.col("id").alias("o"), *[F.col("id").cast("string").alias(c) for c in columns]).write.parquet(path)
    plan = static_plan(sheet.clean_sheet(spark.read.parquet(path), ["o"], "single"))
    assert "EqualTo(Strandedness,single)" in plan
    assert "Extra" not in plan

    stats = str(tmp_path / "stats")
    spark.range(10).select(
        F.col("id").alias("so"),
        *[F.col("id").cast("string").alias(c) for c in ("Sample", "Unused")],
        *[F.col("id").cast("double").alias(c) for c in P.STATS_COLUMNS.values()],
    ).write.parquet(stats)
    source = spark.read.parquet(stats).select("so", "Sample", *[quoted(s).alias(a) for a, s in P.STATS_COLUMNS.items()])
    parts = static_plan(run_facts.stats_parts(source, ["so"], 100))
    assert "Unused" not in parts


def test_skewed_records_are_split(spark):
    """A record key with a third of all rows: adaptive execution splits it in the fill join."""
    from gapwright.operators.fill import drop_helpers, fill_missing

    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "0",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        n = 60_000
        key = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 5000).cast("string")))
        records = spark.range(0, n, 1, 8).select("id", key.alias("k"), F.lit(None).cast("string").alias("v"))
        external = spark.range(0, 5000, 1, 8).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("k"), F.lit("x").alias("v"))
        external = external.union(spark.createDataFrame([("hot", "h")], "k string, v string"))
        done = drop_helpers(fill_missing(records, external, ["k"], ["v"], unlisted="drop"), ["k"])
        assert "skew=true" in final_plan(done)
        assert {r["v"]: r["count"] for r in done.groupBy("v").count().collect()} == {"h": n // 3, "x": n - n // 3}
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
