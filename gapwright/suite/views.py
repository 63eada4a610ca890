"""Inputs of the right shape, derived from the test tables.

One SQL text per view serves both engines. Whole tables are read; the tables hold no missing values and
hardly any repeats, so cells are blanked and keys made foreign by value. Measures are multiples of 1/1024
and weights are whole, so that sums of doubles are exact in any order of summation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

_SAMPLE_L = "'S' || lpad(cast(l_orderkey AS string), 9, '0')"
_SAMPLE_O = "'S' || lpad(cast(o_orderkey AS string), 9, '0')"
_LIBRARY = (
    _SAMPLE_L
    + " || '.P' || cast(l_partkey AS string) || '.' || CASE l_returnflag WHEN 'A' THEN 'SG' WHEN 'N' THEN 'TF' ELSE 'XX' END"
    + " || cast(l_linenumber AS string)"
)

VIEWS = {
    # Library sheet: one row per lane. Some treatments missing, some ids without a dot.
    "v_sheet": f"""
        SELECT {_SAMPLE_L} AS sample_name,
               CASE WHEN l_partkey % 23 = 0 THEN 'L' || cast(l_orderkey AS string) || 'P' || cast(l_partkey AS string) || 'SG1'
                    ELSE {_LIBRARY} END AS library_id,
               CASE l_linestatus WHEN 'F' THEN 'double' ELSE 'single' END AS strandedness,
               CASE l_suppkey % 5 WHEN 0 THEN 'none' WHEN 1 THEN 'half' WHEN 2 THEN 'full' WHEN 3 THEN 'odd' END AS udg_treatment,
               CASE WHEN l_suppkey % 3 <> 0
                    THEN '/run/' || cast(l_suppkey AS string) || '/' || {_LIBRARY} || '_R1.fastq.gz' END AS r1,
               CASE WHEN l_suppkey % 2 = 0 THEN {_LIBRARY} || '.bam' END AS bam,
               l_partkey * 8 + l_linenumber AS row_ord
        FROM {{lineitem}}""",
    # Wide QC table: library rows plus sample rows; some keys unknown to the sheet.
    "v_stats": f"""
        SELECT CASE WHEN l_partkey % 19 = 0 THEN 'Q' || cast(l_partkey AS string) ELSE {_LIBRARY} END AS sample_key,
               l_partkey * 8 + l_linenumber AS stat_ord,
               cast(CASE WHEN l_partkey % 4 = 0 THEN l_linenumber * 0.15 END AS double) AS sexdet_rate_x,
               cast(CASE WHEN l_partkey % 3 = 0 THEN l_linenumber * 0.05 END AS double) AS sexdet_rate_y,
               cast(CASE WHEN l_partkey % 4 = 0 THEN 0.012 END AS double) AS sexdet_err_x,
               cast(CASE WHEN l_partkey % 3 = 0 THEN 0.034 END AS double) AS sexdet_err_y,
               CASE WHEN l_partkey % 11 = 0 THEN NULL ELSE l_discount END AS endogenous_dna,
               cast(NULL AS bigint) AS covered_snps,
               CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE round(l_tax * 100) / 128 END AS damage_5p1,
               CASE WHEN l_partkey % 13 = 0 THEN NULL ELSE cast(floor(l_extendedprice / 100) AS bigint) END AS x_contamination_snps,
               CASE WHEN l_quantity < 5 THEN NULL ELSE round(l_discount * 100) / 128 END AS x_contamination,
               round(l_tax * 100) / 1024 AS x_contamination_error,
               CASE WHEN l_partkey % 17 = 0 THEN cast(0 AS double)
                    WHEN l_partkey % 29 = 0 THEN NULL
                    ELSE l_quantity END AS filtered_mapped_reads
        FROM {{lineitem}}
        UNION ALL
        SELECT {_SAMPLE_O}, -1,
               CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE cast(o_custkey % 130 AS double) / 100 END,
               cast(o_custkey % 70 AS double) / 100,
               cast(o_custkey % 50 AS double) / 1000,
               CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE cast(o_custkey % 40 AS double) / 1000 END,
               NULL,
               CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE cast(floor(o_totalprice) AS bigint) END,
               NULL, NULL, NULL, NULL, NULL
        FROM {{orders}}""",
    # Records with holes; some ids foreign to the run, so that both sides know ids the other lacks.
    "v_records": f"""
        SELECT o_orderkey AS row_ord,
               CASE WHEN o_orderkey % 10 = 0 THEN 'N' ELSE 'S' END || lpad(cast(o_orderkey AS string), 9, '0') AS record_id,
               CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderpriority END AS site,
               CASE WHEN o_orderkey % 2 = 0 THEN NULL ELSE cast(o_orderkey % 8 AS bigint) END AS nr_libraries,
               CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE 'plus' END AS udg,
               CASE o_orderkey % 4 WHEN 0 THEN 'U' WHEN 1 THEN 'F' WHEN 2 THEN NULL ELSE 'M' END AS sex,
               CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE 'haploid' END AS ploidy
        FROM {{orders}}""",
    # Per-tool tables of the second path, keyed by the library ids of v_sheet.
    "v_tools": f"""
        SELECT DISTINCT {_LIBRARY} AS library_id,
               {_LIBRARY} || '.bam' AS bam,
               cast(l_linenumber * 0.15 AS double) AS rate_x,
               cast(l_linenumber * 0.05 AS double) AS rate_y,
               CASE WHEN l_partkey % 11 = 0 THEN NULL ELSE cast(l_partkey % 100 AS double) / 100 END AS endo,
               CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE cast(l_partkey % 37 AS double) / 128 END AS dmg,
               CASE WHEN l_partkey % 31 = 0 THEN NULL ELSE cast(l_partkey % 1000 AS bigint) END AS reads,
               CASE WHEN l_partkey % 13 = 0 THEN NULL ELSE cast(l_partkey % 400 AS bigint) END AS snps,
               cast(l_partkey % 17 AS double) / 128 AS est,
               cast(l_partkey % 5 AS double) / 1024 AS se
        FROM {{lineitem}}""",
}


def tables(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in names}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text = VIEWS[name]
    used = [t for t in TABLES if "{" + t + "}" in text]
    return spark.sql(text, **tables(spark, sf_dir, *used))


def sql(*names: str) -> str:
    """WITH clause that defines the views for the checking engine."""
    plain = {t: t for t in TABLES}
    return "WITH " + ",\n".join(f"{name} AS ({VIEWS[name].format(**plain)})" for name in names)
