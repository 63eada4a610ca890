"""The registered queries: one per operator or job, over whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gapwright.functions import aggregates as A
from gapwright.functions import scalars as S
from gapwright.operators import fill, joins, lists, shape
from gapwright.operators.calibrate import calibrate_dates, curve_for_latitude
from gapwright.plans import compiled, completion, context, run_facts, sheet
from gapwright.plans import presets as P
from gapwright.session import shared_folder, stored
from gapwright.sources import delimited
from gapwright.suite.views import tables, view

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SHEET = {"sample": "sample_name", "unit": "library_id", "build": "strandedness", "treatment": "udg_treatment"}
ORDER, STATS_ORDER = ["row_ord"], ["stat_ord"]
CUTOFF = 300
PIPELINE_URL = "https://example.org/pipeline"
DECIMALS = ["endogenous_dna", "damage_5p1", "x_contamination", "x_contamination_error"]


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def one(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return tables(spark, sf_dir, table)[table]


def clean(spark: SparkSession, sf_dir: str, keep_only: str = "none") -> DataFrame:
    return sheet.clean_sheet(view(spark, sf_dir, "v_sheet"), ORDER, keep_only, files=("r1", "bam"), **SHEET)


def unplace(sheet_rows: DataFrame) -> DataFrame:
    """Some rows lose their place."""
    return sheet_rows.withColumn("row_ord", F.when(F.xxhash64("library_id") % 3 != 0, F.col("row_ord")))


def facts(spark: SparkSession, sf_dir: str, unplaced: bool = False, groups: str = "small", **options) -> DataFrame:
    """An order has at most seven lines by the format of the tables, so samples, libraries and QC keys are small."""
    rows = view(spark, sf_dir, "v_sheet")
    return run_facts.import_run(
        unplace(rows) if unplaced else rows,
        view(spark, sf_dir, "v_stats"),
        ORDER,
        STATS_ORDER,
        cutoff=CUTOFF,
        stats_key="sample_key",
        files=("r1", "bam"),
        groups=groups,
        **SHEET,
        **options,
    ).withColumns({c: F.col(c).cast("double") for c in ("Damage", "Endogenous")})


def lab_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[tuple[DataFrame, str, str]]]:
    """A relational chain: order = individual, customer and nation = site, region = country, line = library."""
    t = tables(spark, sf_dir, "orders", "customer", "nation", "region", "lineitem")
    key = F.col("o_orderkey")
    individuals = t["orders"].select(
        F.concat(F.lit("S"), F.lpad(key.cast("string"), 9, "0")).alias("individual.Full_Individual_Id"),
        F.concat(F.lit('"'), F.col("o_orderpriority"), F.lit('"')).alias("individual.Archaeological_ID"),
        F.when(key % 3 == 0, "").otherwise(F.concat(F.lit("LAB-"), key.cast("string"))).alias("individual.C14_Id"),
        F.col("o_orderstatus").alias("individual.C14_Info"),
        F.when(key % 7 != 0, F.col("o_custkey")).cast("int").alias("individual.C14_Calibrated_From"),
        F.when(key % 7 != 0, F.col("o_custkey") + 100).cast("int").alias("individual.C14_Calibrated_To"),
        (F.col("o_custkey") % 1500 + 200).cast("int").alias("individual.C14_Uncalibrated"),
        (key % 16 + 5).cast("int").alias("individual.C14_Uncalibrated_Variation"),
        F.col("o_custkey").alias("individual.Owner"),
        key.alias("individual.Id"),
    )
    owners = t["customer"].select(
        F.col("c_custkey").alias("owner.Id"),
        F.col("c_nationkey").alias("owner.Nation"),
        F.when(F.col("c_custkey") % 5 == 0, "").otherwise(F.col("c_mktsegment")).alias("site.Locality"),
    )
    nations = t["nation"].select(
        F.col("n_nationkey").alias("nation.Id"),
        F.col("n_regionkey").alias("nation.Region"),
        F.col("n_name").alias("site.Name"),
        (F.col("n_nationkey") * 5 - 60).cast("double").alias("site.Latitude"),
        (F.col("n_nationkey") * 7 - 90).cast("double").alias("site.Longitude"),
    )
    regions = t["region"].select(F.col("r_regionkey").alias("region.Id"), F.col("r_name").alias("site.Country"))
    lines = t["lineitem"].select(
        F.col("l_orderkey").alias("sequencing.Individual"), F.col("l_linenumber").alias("sequencing.Number")
    )
    chain = [
        (owners, "individual.Owner", "owner.Id"),
        (nations, "owner.Nation", "nation.Id"),
        (regions, "nation.Region", "region.Id"),
        (lines, "individual.Id", "sequencing.Individual"),
    ]
    return individuals, chain


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """v_records under the names of the record format."""
    return view(spark, sf_dir, "v_records").select(
        "row_ord",
        F.col("record_id").alias(P.RECORD_ID),
        F.col("site").alias("Site"),
        F.col("nr_libraries").cast("int").alias("Nr_Libraries"),
        F.col("udg").alias("UDG"),
        F.col("sex").alias("Genetic_Sex"),
        F.col("ploidy").alias("Genotype_Ploidy"),
        F.concat(F.lit("rel"), F.col("row_ord").cast("string")).alias("Relation_To"),
    )


def tool_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    t = view(spark, sf_dir, "v_tools")
    s = view(spark, sf_dir, "v_sheet")
    return {
        "sexdet": t.select(
            F.col("bam").alias("sexdet_input_bam"),
            F.col("rate_x").alias("sexdet_ratex"),
            F.col("se").alias("sexdet_rateerrx"),
            F.col("rate_y").alias("sexdet_ratey"),
            F.col("se").alias("sexdet_rateerry"),
        ),
        "snpcov": s.groupBy("sample_name", "strandedness")
        .agg(F.max("row_ord").alias("snpcov_covered_snps"))
        .withColumnsRenamed({"sample_name": "snpcov_sample_name", "strandedness": "snpcov_strandedness"}),
        "endogenous": t.select(
            F.col("library_id").alias("endorspy_library_id"),
            (F.col("endo") / 2).alias("endorspy_endogenous_dna"),
            F.col("endo").alias("endorspy_endogenous_dna_post"),
        ),
        "damage": t.select(
            F.col("library_id").alias("damage_library_id"),
            F.col("dmg").alias("damage_dmg_5p_1"),
            F.col("reads").alias("damage_num_reads"),
        ),
        "contamination": t.select(
            F.col("library_id").alias("angsd_library_id"),
            F.col("snps").alias("angsd_num_snps"),
            F.col("est").alias("angsd_method1_ml_estimate"),
            F.col("se").alias("angsd_method1_ml_se"),
            F.col("se").alias("angsd_method2_mom_estimate"),
            F.col("est").alias("angsd_method2_mom_se"),
        ),
    }


def units(spark: SparkSession, sf_dir: str, without: tuple[str, ...] = (), pre: bool = False, **options) -> DataFrame:
    tools = {n: df for n, df in tool_tables(spark, sf_dir).items() if n not in without}
    if pre:
        tools["endogenous"] = tools["endogenous"].drop("endorspy_endogenous_dna_post")
    rows = view(spark, sf_dir, "v_sheet").select(
        "sample_name", "library_id", "strandedness", "udg_treatment", F.coalesce("bam", "r1").alias("bam"), "row_ord"
    )
    return compiled.compile_units(rows, ORDER, **tools, capture_type="1240K", bam="bam", **SHEET, **options)


def as_double(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("double") for n in names})


# ---------------------------------------------------------------- sheet


@query
def sheet_clean(spark, sf_dir):
    return clean(spark, sf_dir)


@query
def sheet_clean_double(spark, sf_dir):
    return clean(spark, sf_dir, "double")


@query
def sheet_summary(spark, sf_dir):
    return sheet.summarise_sheet(clean(spark, sf_dir), ORDER, ["sample_name"], "strandedness", "udg_treatment", "small")


@query
def sheet_summary_packages(spark, sf_dir):
    """The same under a two-column key: packages of samples side by side."""
    rows = view(spark, sf_dir, "v_sheet").withColumn("package_id", F.col("strandedness"))
    done = sheet.clean_sheet(rows, ORDER, scope=["package_id"], files=("r1", "bam"), **SHEET)
    return sheet.summarise_sheet(done, ORDER, ["package_id", "sample_name"], "strandedness", "udg_treatment")


# ---------------------------------------------------------------- scalars


@query
def code_cascade(spark, sf_dir):
    """All three arms: ids of one character or none fall through to the file names."""
    url = F.col("url")
    rows = one(spark, sf_dir, "pages").select(
        "page_id",
        F.when(F.col("page_id") % 3 == 0, F.substring(url, 1, 1))
        .when(F.col("page_id") % 3 == 1, F.concat(F.lit("X.SG"), F.col("page_id").cast("string")))
        .alias("id"),
        F.when(F.col("page_id") % 2 == 0, F.concat(url, F.lit("/0123456789ABCTF1_R1.fq/"))).alias("file_1"),
        F.when(F.col("page_id") % 5 != 0, F.concat(url, F.lit("/0123456789ABCSG1.bam"))).alias("file_2"),
    )
    arms = [F.nullif(S.code_before_last(F.col("id")), F.lit("")), *[S.code_from_file(F.col(f)) for f in ("file_1", "file_2")]]
    return rows.select("page_id", S.code_from_id(arms, P.CAPTURE_TYPES, P.CAPTURE_OTHER).alias("capture"))


@query
def recode_vocabularies(spark, sf_dir):
    s = view(spark, sf_dir, "v_sheet")
    return s.select(
        "library_id",
        "row_ord",
        S.recode(F.col("udg_treatment"), P.UDG_TREATMENTS, P.UDG_OTHER).alias("udg"),
        S.recode(F.nullif(F.col("strandedness"), F.lit("single")), P.LIBRARY_BUILDS, P.LIBRARY_BUILD_OTHER).alias("built"),
    )


@query
def box_classify(spark, sf_dir):
    x = F.when(F.col("o_orderkey") % 9 != 0, (F.col("o_custkey") % 130).cast("double") / 100)
    y = (F.col("o_orderkey") % 70).cast("double") / 100
    label = S.classify_boxes(x, y, P.sex_boxes(), P.SEX_UNKNOWN)
    return one(spark, sf_dir, "orders").select("o_orderkey", label.alias("sex"))


@query
def hemisphere(spark, sf_dir):
    curve = curve_for_latitude(F.col("c_acctbal"), P.CURVE_NORTH, P.CURVE_SOUTH, strict=True)
    return one(spark, sf_dir, "customer").select("c_custkey", curve.alias("curve"))


@query
def hemisphere_lenient(spark, sf_dir):
    """Latitudes that are missing or no number have no curve."""
    raw = F.when(F.col("c_custkey") % 7 == 0, F.concat(F.col("c_acctbal").cast("string"), F.lit("d"))).when(
        F.col("c_custkey") % 5 != 0, F.col("c_acctbal").cast("string")
    )
    curve = curve_for_latitude(raw, P.CURVE_NORTH, P.CURVE_SOUTH, strict=False)
    return one(spark, sf_dir, "customer").select("c_custkey", curve.alias("curve"))


@query
def key_parts(spark, sf_dir):
    unit = F.col("library_id")
    head, rest = S.split_key(unit)
    return view(spark, sf_dir, "v_sheet").select(
        "library_id",
        "row_ord",
        head.alias("head"),
        rest.alias("rest"),
        S.drop_last(unit, 4).alias("library"),
        S.strip_suffix(unit, ".SG1").alias("plain"),
        S.strip_suffix(unit, "[.]..[0-9]", regex=True).alias("plain_regex"),
        S.base_name(F.col("r1")).alias("file"),
    )


@query
def mask_gate(spark, sf_dir):
    stats = view(spark, sf_dir, "v_stats")
    value, by = F.col("x_contamination").cast("double"), F.col("x_contamination_snps")
    return stats.select(
        "sample_key",
        "stat_ord",
        S.mask_below(value, by, CUTOFF, "keep").alias("kept_if_uncounted"),
        S.mask_below(value, by, CUTOFF, "mask").alias("masked_if_uncounted"),
        S.gate(value, F.nullif(F.split_part(F.col("sample_key"), F.lit("."), F.lit(2)), F.lit("P1"))).alias("gated"),
        S.label_if_present(F.nullif(F.col("sample_key"), F.lit("Q19")), "C14").alias("label"),
        S.sentinel_null(F.col("filtered_mapped_reads").cast("double"), 0.0).alias("reads"),
    )


@query
def number_text(spark, sf_dir):
    """Three-decimal texts, with ties in the fourth decimal, and note templates."""
    x = F.col("l_extendedprice") / 16
    t = F.col("l_tax") / 16
    return one(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        S.fixed3(x).alias("fixed"),
        S.fixed3(F.when(F.col("l_linenumber") != 3, t)).alias("small"),
        S.rate_note(S.fixed3(t), S.fixed3(F.lit(None)), S.fixed3(x), S.fixed3(F.col("l_tax"))).alias("note"),
        S.counts_note(S.count_text(F.nullif(F.col("l_partkey"), F.lit(7))), CUTOFF).alias("counts"),
    )


@query
def text_clean(spark, sf_dir):
    """Character swap over whole texts, blanks and sentinels to missing."""
    docs = one(spark, sf_dir, "documents")
    return docs.select(
        "doc_id",
        S.swap_char(F.col("text"), '"', "'").alias("text"),
        S.sentinel_null(F.col("lang"), "de").alias("lang"),
        S.is_blank(F.nullif(F.col("source"), F.lit("src0"))).alias("no_source"),
    )


@query
def lenient_numbers(spark, sf_dir):
    """Text to numbers: fractions cut off, other text missing."""
    raw = F.when(F.col("p_partkey") % 4 == 0, F.col("p_type")).when(
        F.col("p_partkey") % 4 == 1, F.concat(F.col("p_size").cast("string"), F.lit(".75"))
    ).otherwise(F.concat(F.lit(" "), F.col("p_size").cast("string")))
    return one(spark, sf_dir, "part").select(
        "p_partkey", S.lenient_int(raw).alias("whole"), S.lenient_double(raw).alias("number")
    )


@query
def strict_numbers(spark, sf_dir):
    """Text that only looks like a number, and spellings that are one."""
    size = F.col("p_size").cast("string")
    ends = ["d", "f", "e2", ".", "x", "L", " 1", "E-1"]
    raw = F.concat(size, F.get(F.array(*map(F.lit, ends)), (F.col("p_partkey") % len(ends)).cast("int")))
    return one(spark, sf_dir, "part").select("p_partkey", S.lenient_double(raw).alias("number"))


@query
def sheet_from_text(spark, sf_dir):
    """The sheet written as a tab-separated file and scanned again, by position and with two missing spellings."""
    rows = view(spark, sf_dir, "v_sheet").select("sample_name", "library_id", "strandedness", "udg_treatment", "r1", "bam", "row_ord")
    text = rows.withColumns({"udg_treatment": F.coalesce("udg_treatment", F.when(F.col("row_ord") % 2 == 0, "N/A"))})
    path = f"{shared_folder(spark)}/sheet-{uuid.uuid4().hex}"
    delimited.write_records(text, path, [sf_dir], missing="n/a")
    table, _ = delimited.scan(spark, path, ["n/a", "N/A"], codes="ccccccd")
    return table.select(*rows.columns)


def _text_files(spark: SparkSession, rows: DataFrame, part: Column, order: list[str]) -> str:
    """Rows as text, a folder for each value of `part`, whose files hold its rows in order: as many as their ranges need."""
    path = f"{shared_folder(spark)}/text-{uuid.uuid4().hex}"
    numbered = rows.select("*", *[F.col(c).alias(f"_by_{i}") for i, c in enumerate(order)], part.cast("string").alias("part"))
    text = [S.render(F.col(c), kind, P.MISSING_TEXT).alias(c) for c, kind in rows.dtypes]
    by = [f"_by_{i}" for i in range(len(order))]
    dealt = numbered.select(*text, *by, "part").repartitionByRange("part", *by).sortWithinPartitions("part", *by)
    dealt.drop(*by).write.partitionBy("part").option("sep", "\t").option("header", True).csv(path)
    return path


@query
def row_numbers(spark, sf_dir):
    """A sheet in several files, themselves in pieces, and many splits: each line's number in its file."""
    rows = view(spark, sf_dir, "v_sheet").select("sample_name", "library_id", "r1", "row_ord")
    path = _text_files(spark, rows, F.col("row_ord") % 5, ["row_ord", "library_id", "sample_name"])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        table, order = delimited.scan(spark, path, ["n/a"], pieces=True)
        numbered = f"{path}-numbered"
        table.select("sample_name", "library_id", "row_ord", F.col("part").cast("long").alias("part"), F.col(order[-1]).alias("line")).write.parquet(numbered)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    return spark.read.parquet(numbered)


@query
def records_from_text(spark, sf_dir):
    """A record file written and read: missing spellings, casts, names of an old version, the output order as a column."""
    p = F.col("p_partkey")
    old = one(spark, sf_dir, "part").select(
        F.concat(F.lit("I"), p.cast("string")).alias("Individual_ID"),
        F.when(p % 5 != 0, F.concat(F.col("p_size").cast("string"), F.lit(".7"))).alias("No_of_Libraries"),
        F.col("p_brand").alias("Data_Type"),
        F.when(p % 7 == 0, F.col("p_name")).otherwise(p.cast("string")).alias("Nr_autosomal_SNPs"),
        F.col("p_type").alias("Xcontam"),
        F.when(p % 3 != 0, F.col("p_brand")).alias("Xcontam_stderr"),
        F.when(p % 2 != 0, F.col("p_retailprice").cast("string")).alias("Coverage_1240K"),
    )
    path = _text_files(spark, old, F.substring("Individual_ID", -1, 1), ["Individual_ID"])
    table, order = completion.read_records(spark, path, pieces=True)
    return table.withColumn("part", F.col("part").cast("long")).withColumnRenamed(order[-1], "line").drop(*order)


# ---------------------------------------------------------------- aggregates


@query
def wmean_na(spark, sf_dir):
    stats = view(spark, sf_dir, "v_stats")
    x, w = F.col("x_contamination"), F.col("filtered_mapped_reads")
    key = F.split_part(F.col("sample_key"), F.lit("."), F.lit(1))
    return stats.groupBy(key.alias("sample")).agg(A.weighted_mean(x, w).alias("mean"))


@query
def wmean_pairwise(spark, sf_dir):
    stats = view(spark, sf_dir, "v_stats")
    key = F.split_part(F.col("sample_key"), F.lit("."), F.lit(1))
    mean = A.weighted_mean_pairwise(F.col("damage_5p1"), S.sentinel_null(F.col("filtered_mapped_reads"), 0))
    return stats.groupBy(key.alias("sample")).agg(mean.alias("mean"))


@query
def wmean_distinct(spark, sf_dir):
    rows = one(spark, sf_dir, "lineitem").select(
        "l_suppkey",
        "l_linenumber",
        F.when(F.col("l_discount") > 0.01, F.col("l_discount").cast("decimal(12,4)")).alias("x"),
        F.col("l_tax").cast("decimal(12,4)").alias("y"),
        F.col("l_quantity").cast("decimal(12,2)").alias("w"),
    )
    return joins.distinct_weighted_mean(rows, ["l_suppkey"], "l_linenumber", {"mean_x": ("x", "w"), "mean_y": ("y", "w")})


@query
def collapse_mixed(spark, sf_dir):
    """Aggregate form, and the scalar form over the joined list."""
    s = view(spark, sf_dir, "v_sheet")
    listed = lists.ordered_lists(s, ["sample_name"], {"treatments": F.col("udg_treatment")}, ORDER,
                                 {"udg": A.staged_collapse("udg", F.col("udg_treatment"))})
    return listed.select("sample_name", "udg", A.collapse_list(F.col("treatments")).alias("udg_of_list"))


@query
def concat_ordered(spark, sf_dir):
    s = view(spark, sf_dir, "v_sheet")
    return lists.ordered_lists(s, ["sample_name"], {"treatments": F.col("udg_treatment"), "libraries": F.col("library_id")}, ORDER, groups="small")


@query
def concat_ordered_any(spark, sf_dir):
    """Suppliers with many lines, a third of them without a place and a third at one place."""
    s = view(spark, sf_dir, "v_sheet")
    place = F.when(F.col("row_ord") % 3 == 0, F.col("row_ord")).when(F.col("row_ord") % 3 == 1, F.lit(7))
    rows = s.select(F.substring("r1", 1, 7).alias("run"), "library_id", "udg_treatment", place.alias("row_ord"))
    return lists.ordered_lists(
        rows, ["run"], {"libraries": F.col("library_id"), "treatments": F.col("udg_treatment")}, ORDER,
        {"n": A.staged_count("n")}, where={"treatments": F.col("row_ord").isNull()}, groups="any",
    )


@query
def concat_distinct_ordered(spark, sf_dir):
    s = view(spark, sf_dir, "v_sheet")
    return lists.ordered_distinct_lists(s, ["sample_name"], "treatments", ["udg_treatment"], ORDER)


@query
def concat_distinct_pairs(spark, sf_dir):
    """Distinct (flag, quantity) pairs per order, printed by quantity."""
    rows = one(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_returnflag", "l_quantity", (F.col("l_partkey") * 8 + F.col("l_linenumber")).alias("row_ord")
    )
    return lists.ordered_distinct_lists(
        rows, ["l_orderkey"], "quantities", ["l_returnflag", "l_quantity"], ORDER, S.count_text(F.col("l_quantity"))
    )


@query
def first_valid(spark, sf_dir):
    value = F.when(F.col("event_type") != "click", F.col("value"))
    props = F.when(F.col("value") > 5, F.col("event_type"))
    return one(spark, sf_dir, "events").groupBy("user_id").agg(
        A.first_valid(value, F.col("event_id")).alias("first_value"),
        A.first_valid(props, F.col("event_id")).alias("first_type"),
    )


@query
def max_strict(spark, sf_dir):
    value = F.when(F.col("l_suppkey") % 9 != 0, F.col("l_extendedprice"))
    return one(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(A.max_strict(value).alias("top"))


@query
def max_valid(spark, sf_dir):
    return view(spark, sf_dir, "v_sheet").groupBy("sample_name").agg(
        A.max_valid(F.when(F.col("udg_treatment").isNotNull(), F.col("row_ord"))).alias("last_treated")
    )


@query
def count_distinct_null(spark, sf_dir):
    return view(spark, sf_dir, "v_sheet").groupBy("sample_name").agg(
        A.count_distinct_with_null(F.col("udg_treatment")).alias("n_treatments"),
        F.count(F.lit(1)).alias("n_rows"),
    )


@query
def repeat_label(spark, sf_dir):
    return one(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n")).select(
        "l_orderkey", A.repeat_label("1240K", F.col("n")).alias("labels"), A.repeat_label(None, F.col("n")).alias("none")
    )


# ---------------------------------------------------------------- joins


@query
def members(spark, sf_dir):
    """QC rows whose key is a known sample or library."""
    ids = joins.member_ids(view(spark, sf_dir, "v_sheet"), "sample_name", "library_id")
    kept = joins.keep_members(view(spark, sf_dir, "v_stats"), "sample_key", ids, "id")
    return kept.select("sample_key", "stat_ord", "sexdet_rate_y")


@query
def grain_resolve(spark, sf_dir):
    """QC rows brought to samples: library rows by their library, others by their own key."""
    libraries = clean(spark, sf_dir).select("sample_name", "library_id")
    stats = view(spark, sf_dir, "v_stats").select("sample_key", "stat_ord", "x_contamination_snps", "covered_snps")
    resolved = joins.resolve_grain(stats, libraries, "sample_key", "library_id", "sample_name")
    return resolved.groupBy("sample_name").agg(
        F.count_if(F.col("is_unit")).alias("n_units"),
        F.count_if(~F.col("is_unit")).alias("n_loose"),
        F.count("stat_ord").alias("n_stats"),
        F.max(F.coalesce("covered_snps", "x_contamination_snps")).alias("snps"),
    )


@query
def facet_merge(spark, sf_dir):
    """Three facets, each missing other samples, in one row per sample. The clean sheet is read six times, so it is a table."""
    s = stored(clean(spark, sf_dir))
    shotgun = s.filter(F.col("Seq_Type") == "Shotgun").groupBy("sample_name").agg(F.count(F.lit(1)).alias("n_shotgun"))
    plus = s.filter(F.col("udg_treatment") == "plus").groupBy("sample_name").agg(F.max("row_ord").alias("last_plus"))
    singles = s.filter(F.col("strandedness") == "ss").groupBy("sample_name").agg(F.min("row_ord").alias("first_single"))
    return joins.merge_facets([shotgun, plus, singles], ["sample_name"])


@query
def facet_merge_duplicates(spark, sf_dir):
    """Facets that repeat keys and lack some; two and three of them mean the same."""
    t = tables(spark, sf_dir, "supplier", "customer", "nation")
    region = F.when(F.col("n_nationkey") % 5 != 0, F.col("n_regionkey"))
    key = lambda name, repeats: F.nullif(F.floor(F.col(name) / repeats), F.lit(3)).alias("k")
    a = t["supplier"].select(key("s_suppkey", 2), F.col("s_name").alias("a"))
    b = t["customer"].select(key("c_custkey", 3), F.col("c_name").alias("b"))
    c = t["nation"].select(region.cast(a.schema["k"].dataType).alias("k"), F.col("n_name").alias("c"))
    two = joins.merge_facets([a, b], ["k"]).withColumn("c", F.lit(None).cast("string"))
    return two.withColumn("n", F.lit(2)).unionByName(joins.merge_facets([a, b, c], ["k"]).withColumn("n", F.lit(3)))


@query
def chain_context(spark, sf_dir):
    """Requested ids through the chain to record columns, without calibration."""
    individuals, chain = lab_tables(spark, sf_dir)
    ids = completion.context_ids(records(spark, sf_dir), P.RECORD_ID)
    return context.import_context(individuals, chain, ids)


@query
def chain_context_guarded(spark, sf_dir):
    """The same, failing in its own job if no id is known, with a strict choice of the curve."""
    individuals, chain = lab_tables(spark, sf_dir)
    ids = completion.context_ids(records(spark, sf_dir), P.RECORD_ID)
    return context.import_context(individuals, chain, ids, require_rows=True)


# ---------------------------------------------------------------- run facts


@query
def facets_endogenous(spark, sf_dir):
    return facts(spark, sf_dir).select("sample_name", "Endogenous")


@query
def facets_contamination(spark, sf_dir):
    return facts(spark, sf_dir, with_means=True).select(
        "sample_name",
        "Contamination",
        "Contamination_Err",
        "Contamination_Meas",
        "Contamination_Note",
        "contamination_mean",
        "contamination_err_mean",
    )


@query
def facets_sex(spark, sf_dir):
    return facts(spark, sf_dir).select("sample_name", "Genetic_Sex", "Sex_Determination_Note", "Damage", "Nr_SNPs")


@query
def run_import(spark, sf_dir):
    return facts(spark, sf_dir)


@query
def run_import_single(spark, sf_dir):
    return facts(spark, sf_dir, keep_only="single")


@query
def run_import_any(spark, sf_dir):
    """The same facts by the plan for samples and QC keys of any size."""
    return facts(spark, sf_dir, groups="any")


@query
def run_import_unplaced(spark, sf_dir):
    """Rows without a place in the sheet count like others."""
    return facts(spark, sf_dir, unplaced=True, groups="placed").select(
        "sample_name", "Nr_Libraries", "Library_Built", "Endogenous", "Damage", "Nr_SNPs", "Contamination", "Contamination_Err"
    )


# ---------------------------------------------------------------- completion


@query
def schema_upgrade(spark, sf_dir):
    """An old record table: renamed, cast leniently, two columns added."""
    p = F.col("p_partkey")
    old = one(spark, sf_dir, "part").select(
        F.concat(F.lit("I"), p.cast("string")).alias("Individual_ID"),
        F.when(p % 5 == 0, "n/a").otherwise(F.concat(F.col("p_size").cast("string"), F.lit(".7"))).alias("No_of_Libraries"),
        F.col("p_brand").alias("Data_Type"),
        F.when(p % 7 == 0, F.col("p_name")).otherwise(p.cast("string")).alias("Nr_autosomal_SNPs"),
        F.col("p_type").alias("Xcontam"),
        F.when(p % 3 == 0, "n/a").otherwise(F.col("p_brand")).alias("Xcontam_stderr"),
        F.when(p % 2 == 0, "n/a").otherwise(F.col("p_retailprice").cast("string")).alias("Coverage_1240K"),
    )
    return completion.standardise_records(old)


@query
def collate(spark, sf_dir):
    """Context by suffix-stripped id, full-joined with the run facts."""
    individuals, chain = lab_tables(spark, sf_dir)
    ids = completion.context_ids(records(spark, sf_dir), P.RECORD_ID, "9", scope=[])
    found = context.import_context(individuals, chain, ids)
    return completion.collate(ids, found, facts(spark, sf_dir, by_unit=True), P.RECORD_ID, "sample_name").select(
        P.RECORD_ID, "Site", "Country", "Location", "Date_C14_Labnr", "Date_BC_AD_Start", "Nr_Libraries", "Capture_Type", "Genetic_Sex"
    )


@query
def fill_missing(spark, sf_dir):
    """Holes filled from external values; foreign external rows kept without their id."""
    external = sheet.summarise_sheet(clean(spark, sf_dir), ORDER, ["sample_name"], "strandedness", "udg_treatment").select(
        F.col("sample_name").alias("record_id"), F.col("Nr_Libraries").alias("nr_libraries"), F.col("UDG").alias("udg"), "Library_Built"
    )
    done = fill.fill_missing(
        view(spark, sf_dir, "v_records"), external, ["record_id"], ["nr_libraries", "udg"], {"ploidy": "diploid"}, keep_extra=True
    )
    return fill.drop_helpers(done, ["record_id"])


def _linked(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = facts(spark, sf_dir).select(
        F.col("sample_name").alias("record_id"), F.col("Genetic_Sex").alias("sex"), F.col("Sex_Determination_Note").alias("note")
    )
    old = view(spark, sf_dir, "v_records").withColumn("note", F.when(F.col("row_ord") % 8 < 4, F.lit("kept")))
    link = fill.Linked("sex", "note", "U")
    return fill.fill_missing(old, found, ["record_id"], [], linked=link, unlisted="keep", keep_old="old_sex")


@query
def linked_fill(spark, sf_dir):
    return _linked(spark, sf_dir).select("record_id", "old_sex", "sex", "note")


@query
def change_report(spark, sf_dir):
    return fill.change_report(_linked(spark, sf_dir), ["record_id"], "old_sex", "sex")


@query
def duplicate_keys(spark, sf_dir):
    return fill.duplicate_keys(one(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def render_records(spark, sf_dir):
    """All cells as text, whole numbers without a decimal point, missing spelled out."""
    return shape.render_all(
        one(spark, sf_dir, "orders").select(
            "o_orderkey",
            F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderpriority")).alias("priority"),
            F.when(F.col("o_orderkey") % 4 != 0, F.floor(F.col("o_totalprice")).cast("double")).alias("price"),
            (F.col("o_custkey") / 8).alias("share"),
        )
    )


@query
def fill_records(spark, sf_dir):
    external = stored(facts(spark, sf_dir).withColumnRenamed("sample_name", P.RECORD_ID))
    return completion.fill_records(records(spark, sf_dir), external, "haploid", ORDER, PIPELINE_URL).select(
        P.RECORD_ID, "Relation_To", "Site", "Nr_Libraries", "Capture_Type", "UDG", "Library_Built", "Genetic_Sex",
        "Genotype_Ploidy", "Note", "Sex_Determination_Note", P.PIPELINE_URL,
    )


def _completed(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    individuals, chain = lab_tables(spark, sf_dir)
    stats = view(spark, sf_dir, "v_stats")
    return completion.complete_records(
        records(spark, sf_dir),
        view(spark, sf_dir, "v_sheet"),
        stats,
        lambda ids: context.import_context(individuals, chain, ids.select("context_id")),
        "haploid",
        PIPELINE_URL,
        orders=(ORDER, ORDER, STATS_ORDER),
        cutoff=CUTOFF,
        run_options={"stats_key": "sample_key", "files": ("r1", "bam"), "groups": "small", "by_unit": True, **SHEET},
        **options,
    )


@query
def complete_records(spark, sf_dir):
    """End to end: records, sheet, QC table and lab chain to the completed record table as text."""
    return shape.render_all(_completed(spark, sf_dir))


@query
def completion_counts(spark, sf_dir):
    """What the job that writes completed records has counted on its way."""
    counted = Observation("completion")
    _completed(spark, sf_dir, observation=counted).write.parquet(f"{shared_folder(spark)}/records-{uuid.uuid4().hex}")
    # the counts that the writing job took: one row, whatever the size of the tables
    return spark.createDataFrame([tuple(counted.get[c] for c in ("rows", "unlisted", "unmatched", "repeated", "changed"))], "rows long, unlisted long, unmatched long, repeated long, changed long")


@query
def completion_changes(spark, sf_dir):
    """The changed sex calls of the whole job."""
    done = _completed(spark, sf_dir, keep_old="old_sex", unlisted="keep")
    return fill.change_report(done, [P.RECORD_ID], "old_sex", P.SEX)


# ---------------------------------------------------------------- second path


@query
def compile_units(spark, sf_dir):
    return as_double(units(spark, sf_dir), "Contamination", "Contamination_Err")


@query
def compile_units_partial(spark, sf_dir):
    """Three of the five tables absent: the same columns, empty. Other method and algorithm."""
    return as_double(
        units(spark, sf_dir, without=("sexdet", "snpcov", "damage"), method="2", algorithm="mom"),
        "Contamination",
        "Contamination_Err",
    )


@query
def rollup_units(spark, sf_dir):
    """An order has at most seven lines, so its samples and libraries are small."""
    rows = stored(units(spark, sf_dir))
    done = compiled.rollup_units(rows, ORDER, 100, "sample_name", "library_id", groups="small")
    return done.select(
        "sample_name", "library_id", "row_ord", "Contamination", "Contamination_Err", "Contamination_Note",
        "Contamination_Meas", "Damage", "Endogenous", "Library_Names",
    )


@query
def rollup_units_any(spark, sf_dir):
    """The same by the plan for samples and libraries of any size."""
    rows = stored(units(spark, sf_dir))
    done = compiled.rollup_units(rows, ORDER, 100, "sample_name", "library_id", groups="any")
    return done.select(
        "sample_name", "library_id", "row_ord", "Contamination", "Contamination_Err", "Contamination_Note",
        "Contamination_Meas", "Damage", "Endogenous", "Library_Names",
    )


@query
def rollup_unplaced(spark, sf_dir):
    """Rows without a place, and NaN among the values."""
    rows = unplace(stored(units(spark, sf_dir)))
    nan = F.lit(float("nan"))
    rows = rows.withColumn("Endogenous", F.coalesce("Endogenous", nan)).withColumn("Damage", F.coalesce("Damage", nan))
    done = compiled.rollup_units(rows, ORDER, 100, "sample_name", "library_id")
    return done.select("sample_name", "library_id", "Contamination", "Contamination_Err", "Contamination_Meas", "Damage", "Endogenous")


@query
def compile_units_pre(spark, sf_dir):
    """An endogenous table that has the value before capture only."""
    return units(spark, sf_dir, pre=True).select("sample_name", "library_id", "row_ord", "Endogenous")


# ---------------------------------------------------------------- calibration


def curve_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A curve out of the part table: one year per part, a slight wiggle, two hemispheres."""
    year = F.col("p_partkey").cast("int")
    base = one(spark, sf_dir, "part").select(
        year.alias("cal_bp"),
        (year + (F.col("p_partkey") % 10)).cast("double").alias("c14_age"),
        (F.col("p_partkey") % 3 + 8).cast("double").alias("c14_sigma"),
    )
    north = base.select(F.lit(P.CURVE_NORTH).alias("curve"), "*")
    return north.unionByName(north.withColumns({"curve": F.lit(P.CURVE_SOUTH), "c14_age": F.col("c14_age") + 30}))


@query
def calibrate_batch(spark, sf_dir):
    dates = one(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 11 != 0, F.col("o_custkey") % 1500 + 200).cast("int").alias("age"),
        (F.col("o_orderkey") % 16 + 5).cast("int").alias("error"),
        F.when(F.col("o_orderkey") % 2 == 0, P.CURVE_NORTH).otherwise(P.CURVE_SOUTH).alias("curve"),
    )
    return calibrate_dates(dates, curve_table(spark, sf_dir), "age", "error", "curve")


@query
def calibrate_outside(spark, sf_dir):
    """Dates before, on and far beyond the curve, with errors from small to absurd."""
    key = F.col("c_custkey")
    dates = one(spark, sf_dir, "customer").select(
        "c_custkey",
        (key % 40 * 97 - 500).cast("int").alias("age"),
        F.when(key % 50 == 7, 1_000_000_000).otherwise(key % 9 * 4 + 2).cast("int").alias("error"),
        F.when(key % 2 == 0, P.CURVE_NORTH).otherwise(P.CURVE_SOUTH).alias("curve"),
    )
    return calibrate_dates(dates, curve_table(spark, sf_dir), "age", "error", "curve")


@query
def context_calibrated(spark, sf_dir):
    """Context with trusted uncalibrated dates: lab years first, calibrated ones where they lack."""
    individuals, chain = lab_tables(spark, sf_dir)
    ids = completion.context_ids(records(spark, sf_dir), P.RECORD_ID)
    found = context.import_context(individuals, chain, ids, curve=curve_table(spark, sf_dir), trust_uncalibrated=True)
    return found.select(
        "context_id", "Date_BC_AD_Start", "Date_BC_AD_Stop", "Date_BC_AD_Median", "Date_C14_Uncal_BP",
        "Date_C14_Uncal_BP_Err", "Date_Type", "Date_Note",
    )
