"""SQL for the checking engine: the same results the long way round, facet by facet and join by join."""

from __future__ import annotations

from gapwright.plans import presets as P
from gapwright.suite import queries as Q
from gapwright.suite.views import sql

_CODE = """CASE {0} WHEN 'SG' THEN 'Shotgun' WHEN 'TF' THEN '1240K' ELSE 'OtherCapture' END"""
_UDG = "CASE {0} WHEN 'none' THEN 'minus' WHEN 'half' THEN 'half' WHEN 'full' THEN 'plus' ELSE 'mixed' END"
_BUILT = "CASE {0} WHEN 'single' THEN 'ss' WHEN 'double' THEN 'ds' ELSE 'other' END"
_SEX = """CASE WHEN {0} BETWEEN 0.7 AND 1.2 AND {1} BETWEEN 0.0 AND 0.1 THEN 'F'
               WHEN {0} BETWEEN 0.2 AND 0.6 AND {1} BETWEEN 0.3 AND 0.6 THEN 'M' ELSE 'U' END"""


def _fixed(x: str) -> str:
    return f"CASE WHEN {x} IS NOT NULL THEN printf('%.3f', {x}) END"


def _sig(x: str) -> str:
    return (
        f"CASE WHEN {x} IS NULL THEN NULL WHEN {x} = 0 OR abs({x}) BETWEEN 0.00095 AND 95000"
        f" THEN printf('%.3f', {x}) ELSE printf('%.0e', {x}) END"
    )


def _rates(xr: str, xe: str, yr: str, ye: str) -> str:
    return (
        f"'x-rate: ' || coalesce({xr}, 'NA') || ' +- ' || coalesce({xe}, 'NA') ||"
        f" ', y-rate: ' || coalesce({yr}, 'NA') || ' +- ' || coalesce({ye}, 'NA')"
    )


def _counts_note(counts: str, cutoff: int) -> str:
    return (
        f"'Nr Snps (per library): ' || {counts} || '. Estimate and error are weighted means of values per library."
        f" Libraries with fewer than {cutoff} were excluded.'"
    )


def _libs(where: str = "") -> str:
    """v_libs: the cleaned sheet."""
    return f"""v_libs AS (
    SELECT sample_name, library_id, {_BUILT.format('strandedness')} AS strandedness, {_UDG.format('udg_treatment')} AS udg_treatment,
           left(library_id, greatest(length(library_id) - 4, 0)) AS "Library",
           {_CODE.format("substr(library_id, length(library_id) - 2, 2)")} AS "Seq_Type",
           min(row_ord) AS row_ord
    FROM v_sheet {where} GROUP BY ALL)"""


_SUMMARY = """v_summary AS (
    SELECT sample_name, count(*) AS "Nr_Libraries", string_agg("Seq_Type", ';' ORDER BY row_ord, "Seq_Type") AS "Capture_Type",
           CASE WHEN count(DISTINCT udg_treatment) = 1 THEN min(udg_treatment) ELSE 'mixed' END AS "UDG",
           CASE WHEN count(DISTINCT strandedness) = 1 THEN min(strandedness) ELSE 'mixed' END AS "Library_Built"
    FROM v_libs GROUP BY sample_name)"""

# The QC table the long way: wanted rows, then one join and one grouping per facet.
_FACETS = f"""v_wanted AS (
    SELECT * FROM v_stats WHERE sample_key IN (SELECT sample_name FROM v_libs UNION SELECT library_id FROM v_libs)),
v_endogenous AS (
    SELECT sample_name, CASE WHEN count(*) = count(endogenous_dna) THEN max(endogenous_dna) END AS endogenous
    FROM v_libs LEFT JOIN v_wanted ON sample_key = library_id WHERE "Seq_Type" = 'Shotgun' GROUP BY sample_name),
v_masked AS (
    SELECT sample_name, row_ord, stat_ord, x_contamination_snps AS snps, filtered_mapped_reads AS reads,
           CASE WHEN x_contamination_snps < {Q.CUTOFF} THEN NULL ELSE x_contamination END AS est,
           CASE WHEN x_contamination_snps < {Q.CUTOFF} THEN NULL ELSE x_contamination_error END AS err
    FROM v_libs LEFT JOIN v_wanted ON sample_key = library_id WHERE contains(library_id, '.')),
v_contamination AS (
    SELECT sample_name,
           CASE WHEN count(*) FILTER (est IS NOT NULL AND reads IS NULL) = 0
                THEN cast(sum(est * reads) AS double) / nullif(cast(sum(reads) FILTER (est IS NOT NULL) AS double), 0) END AS mean,
           CASE WHEN count(*) FILTER (err IS NOT NULL AND reads IS NULL) = 0
                THEN cast(sum(err * reads) AS double) / nullif(cast(sum(reads) FILTER (err IS NOT NULL) AS double), 0) END AS err_mean,
           string_agg(coalesce(cast(snps AS varchar), 'NA'), ';' ORDER BY stat_ord NULLS LAST, coalesce(cast(snps AS varchar), 'NA')) AS counts
    FROM v_masked GROUP BY sample_name),
v_all AS (
    SELECT coalesce(sample_name, sample_key) AS sample_name, v_wanted.* EXCLUDE (filtered_mapped_reads),
           nullif(filtered_mapped_reads, 0) AS reads
    FROM v_wanted FULL JOIN v_libs ON sample_key = library_id),
v_sex AS (
    SELECT sample_name,
           arg_min(sexdet_rate_x, stat_ord) FILTER (sexdet_rate_x IS NOT NULL) AS xr,
           arg_min(sexdet_rate_y, stat_ord) FILTER (sexdet_rate_y IS NOT NULL) AS yr,
           arg_min(sexdet_err_x, stat_ord) FILTER (sexdet_err_x IS NOT NULL) AS xe,
           arg_min(sexdet_err_y, stat_ord) FILTER (sexdet_err_y IS NOT NULL) AS ye,
           cast(sum(damage_5p1 * reads) AS double) / nullif(cast(sum(reads) FILTER (damage_5p1 IS NOT NULL) AS double), 0) AS damage,
           max(covered_snps) AS nr_snps
    FROM v_all GROUP BY sample_name),
v_facts AS (
    SELECT s.sample_name, "Nr_Libraries", "Capture_Type", "UDG", "Library_Built",
           {_SEX.format('xr', 'yr')} AS "Genetic_Sex", damage AS "Damage", nr_snps AS "Nr_SNPs",
           {_rates(_fixed('xr'), _fixed('xe'), _fixed('yr'), _fixed('ye'))} AS "Sex_Determination_Note",
           cast(endogenous AS double) AS "Endogenous",
           {_fixed('mean')} AS "Contamination", {_fixed('err_mean')} AS "Contamination_Err",
           CASE WHEN mean IS NOT NULL THEN 'ANGSD' END AS "Contamination_Meas",
           CASE WHEN mean IS NOT NULL THEN {_counts_note('counts', Q.CUTOFF)} END AS "Contamination_Note",
           mean AS contamination_mean, err_mean AS contamination_err_mean
    FROM v_summary s LEFT JOIN v_sex USING (sample_name) LEFT JOIN v_endogenous USING (sample_name)
         LEFT JOIN v_contamination USING (sample_name))"""


def _facts(tail: str, *more: str, where: str = "", extra: str = "") -> str:
    ctes = [sql("v_sheet", "v_stats", *more), _libs(where), _SUMMARY, _FACETS]
    return ",\n".join(ctes) + extra + "\n" + tail


_NO_MEANS = "* EXCLUDE (contamination_mean, contamination_err_mean)"

_IDS = f"""v_ids AS (SELECT DISTINCT record_id AS "{P.RECORD_ID}", {{0}} AS context_id FROM v_records)"""

_CHAIN = """v_chain AS (
    SELECT DISTINCT 'S' || lpad(cast(o_orderkey AS varchar), 9, '0') AS id,
           '"' || o_orderpriority || '"' AS arch,
           CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 'LAB-' || cast(o_orderkey AS varchar) END AS lab,
           o_orderstatus AS info,
           CASE WHEN o_orderkey % 7 <> 0 THEN cast(o_custkey AS integer) END AS d_from,
           CASE WHEN o_orderkey % 7 <> 0 THEN cast(o_custkey + 100 AS integer) END AS d_to,
           cast(o_custkey % 1500 + 200 AS integer) AS age, cast(o_orderkey % 16 + 5 AS integer) AS error,
           CASE WHEN c_custkey % 5 <> 0 THEN c_mktsegment END AS locality,
           n_name, r_name, cast(n_nationkey * 5 - 60 AS double) AS lat, cast(n_nationkey * 7 - 90 AS double) AS lon
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
         LEFT JOIN region ON n_regionkey = r_regionkey LEFT JOIN lineitem ON l_orderkey = o_orderkey)"""

_CONTEXT = """v_found AS (
    SELECT id AS context_id, replace(arch, '"', '''') AS "Collection_ID", r_name AS "Country", n_name AS "Site",
           locality AS "Location", lon AS "Longitude", lat AS "Latitude", lab AS "Date_C14_Labnr",
           CASE WHEN lab IS NOT NULL THEN d_from END AS "Date_BC_AD_Start", CASE WHEN lab IS NOT NULL THEN d_to END AS "Date_BC_AD_Stop",
           cast(NULL AS integer) AS "Date_BC_AD_Median", cast(NULL AS integer) AS "Date_C14_Uncal_BP",
           cast(NULL AS integer) AS "Date_C14_Uncal_BP_Err", CASE WHEN lab IS NOT NULL THEN 'C14' END AS "Date_Type",
           CASE WHEN lab IS NOT NULL THEN info END AS "Date_Note"
    FROM v_chain WHERE id IN (SELECT context_id FROM v_ids))"""

_CURVE = f"""v_part AS (
    SELECT p_partkey AS cal_bp, cast(p_partkey + p_partkey % 10 AS double) AS c14, cast(p_partkey % 3 + 8 AS double) AS sigma FROM part),
v_curve AS (
    SELECT '{P.CURVE_NORTH}' AS curve, cal_bp, c14, sigma FROM v_part
    UNION ALL SELECT '{P.CURVE_SOUTH}', cal_bp, c14 + 30, sigma FROM v_part)"""


def _calibrated(dates: str) -> str:
    """v_cal: calibrated years per distinct date of `dates` (curve, age, error)."""
    return f"""v_dates AS (SELECT DISTINCT curve, cast(age AS double) AS age, cast(error AS double) AS error FROM {dates} WHERE age IS NOT NULL),
v_log AS (
    SELECT d.curve, age, error, cal_bp,
           -((age - c14) * (age - c14)) / (2 * (error * error + sigma * sigma)) - ln(error * error + sigma * sigma) / 2 AS log_density
    FROM v_dates d JOIN v_curve c ON d.curve = c.curve),
v_near AS (
    SELECT curve, age, error, cal_bp, exp(log_density - max(log_density) OVER (PARTITION BY curve, age, error)) AS density FROM v_log),
v_share AS (
    SELECT *, density / sum(density) OVER (PARTITION BY curve, age, error) AS p FROM v_near),
v_mass AS (
    SELECT *, sum(p) OVER (PARTITION BY curve, age, error ORDER BY cal_bp DESC ROWS UNBOUNDED PRECEDING) AS by_year,
           sum(p) OVER (PARTITION BY curve, age, error ORDER BY density DESC, cal_bp ROWS UNBOUNDED PRECEDING) - p AS denser
    FROM v_share),
v_cal AS (
    SELECT curve, age, error,
           cast(1950 - max(cal_bp) FILTER (by_year >= 0.5) AS integer) AS "Date_BC_AD_Median",
           cast(1950 - max(cal_bp) FILTER (denser < 0.6827) AS integer) AS "Date_BC_AD_Start_1Sigma",
           cast(1950 - min(cal_bp) FILTER (denser < 0.6827) AS integer) AS "Date_BC_AD_Stop_1Sigma",
           cast(1950 - max(cal_bp) FILTER (denser < 0.9545) AS integer) AS "Date_BC_AD_Start_2Sigma",
           cast(1950 - min(cal_bp) FILTER (denser < 0.9545) AS integer) AS "Date_BC_AD_Stop_2Sigma"
    FROM v_mass GROUP BY curve, age, error)"""


def _compiled(partial: bool = False) -> str:
    """v_units: the sheet with the tool tables joined on."""
    est, se = ("se", "est") if partial else ("est", "se")
    sex = _SEX.format("t.rate_x", "t.rate_y")
    # A BAM without sex results leaves both columns missing.
    sex_columns = (
        "cast(NULL AS varchar) AS \"Genetic_Sex\", cast(NULL AS varchar) AS \"Sex_Determination_Note\","
        if partial
        else f"""CASE WHEN b.bam IS NOT NULL THEN {sex.replace('t.', 'b.')} END AS "Genetic_Sex",
           CASE WHEN b.bam IS NOT NULL THEN {_rates(_sig('b.rate_x'), _sig('cast(b.se AS double)'), _sig('b.rate_y'), _sig('cast(b.se AS double)'))} END
           AS "Sex_Determination_Note","""
    )
    snps = 'cast(NULL AS integer) AS "Nr_SNPs",' if partial else 'c.snps AS "Nr_SNPs",'
    damage = (
        'cast(NULL AS double) AS "Damage", cast(NULL AS integer) AS damage_num_reads,'
        if partial
        else 'd.damage AS "Damage", t.reads AS damage_num_reads,'
    )
    return f"""v_rows AS (
    SELECT sample_name, library_id, strandedness, udg_treatment, coalesce(bam, r1) AS bam, min(row_ord) AS row_ord
    FROM v_sheet GROUP BY ALL),
v_builds AS (
    SELECT sample_name, strandedness, count(DISTINCT coalesce(library_id, '?')) AS n,
           CASE WHEN count(DISTINCT coalesce(udg_treatment, '?')) > 1 THEN 'mixed' ELSE {_UDG.format('min(udg_treatment)')} END AS udg
    FROM v_sheet GROUP BY sample_name, strandedness),
v_counts AS (SELECT sample_name, strandedness, max(row_ord) AS snps FROM v_sheet GROUP BY sample_name, strandedness),
v_damage AS (
    SELECT sample_name, cast(sum(dmg * reads) AS double) / nullif(cast(sum(reads) FILTER (dmg IS NOT NULL) AS double), 0) AS damage
    FROM v_rows LEFT JOIN v_tools USING (library_id) GROUP BY sample_name),
v_units AS (
    SELECT r.*, u.udg AS "UDG", u.n AS "Nr_Libraries", rtrim(repeat('1240K;', u.n), ';') AS "Capture_Type",
           {_BUILT.format('r.strandedness')} AS "Library_Built", {sex_columns} {snps} t.endo AS "Endogenous", {damage}
           t.snps AS "Contamination_NrSnps", cast(t.{est} AS double) AS "Contamination", cast(t.{se} AS double) AS "Contamination_Err",
           CASE WHEN t.library_id IS NOT NULL THEN 'ANGSD' END AS "Contamination_Meas",
           t.{est} AS est, t.{se} AS se
    FROM v_rows r JOIN v_builds u USING (sample_name, strandedness) LEFT JOIN v_counts c USING (sample_name, strandedness)
         LEFT JOIN v_tools t ON t.library_id = r.library_id LEFT JOIN v_tools b ON b.bam = r.bam
         LEFT JOIN v_damage d ON d.sample_name = r.sample_name)"""


def _distinct_mean(name: str, x: str, w: str) -> str:
    return f"""{name} AS (
    SELECT sample_name, CASE WHEN count(*) FILTER (x IS NOT NULL AND w IS NULL) = 0
                             THEN cast(sum(x * w) AS double) / nullif(cast(sum(w) FILTER (x IS NOT NULL) AS double), 0) END AS mean
    FROM (SELECT DISTINCT sample_name, library_id, {x} AS x, {w} AS w FROM v_units) t GROUP BY sample_name)"""


_ROLLUP = f"""{_distinct_mean('v_est', 'CASE WHEN "Contamination_NrSnps" >= 100 THEN est END', '"Contamination_NrSnps"')},
{_distinct_mean('v_err', 'CASE WHEN "Contamination_NrSnps" >= 100 THEN se END', '"Contamination_NrSnps"')},
{_distinct_mean('v_dmg', '"Damage"', 'damage_num_reads')},
v_pairs AS (
    SELECT sample_name, string_agg(coalesce(cast(snps AS varchar), 'NA'), ';' ORDER BY place, coalesce(cast(snps AS varchar), 'NA')) AS counts
    FROM (SELECT sample_name, library_id, "Contamination_NrSnps" AS snps, min(row_ord) AS place FROM v_units GROUP BY ALL) t GROUP BY sample_name),
v_names AS (
    SELECT sample_name, string_agg(library_id, ';' ORDER BY place, library_id) AS names
    FROM (SELECT sample_name, library_id, min(row_ord) AS place FROM v_units GROUP BY ALL) t GROUP BY sample_name),
v_best AS (SELECT sample_name, max("Endogenous") AS best FROM v_units GROUP BY sample_name)
SELECT u.sample_name, u.library_id, u.row_ord, {_sig('e.mean')} AS "Contamination", {_sig('r.mean')} AS "Contamination_Err",
       CASE WHEN e.mean IS NOT NULL THEN {_counts_note('counts', 100)}
            ELSE 'No results found, or no libraries exceeded cutoff of 100 SNPs after depth filtering.' END AS "Contamination_Note",
       CASE WHEN e.mean IS NOT NULL THEN 'ANGSD' END AS "Contamination_Meas", {_sig('d.mean')} AS "Damage", best AS "Endogenous",
       names AS "Library_Names"
FROM v_units u JOIN v_est e USING (sample_name) JOIN v_err r USING (sample_name) JOIN v_dmg d USING (sample_name)
     JOIN v_pairs USING (sample_name) JOIN v_names USING (sample_name) JOIN v_best USING (sample_name)"""

_FILL_JOIN = "v_records r FULL JOIN v_facts x ON r.record_id = x.sample_name"
_SEX_NEW = "coalesce(nullif(r.sex, 'U'), x.\"Genetic_Sex\")"


def _sex_note(old_note: str) -> str:
    new_note = 'x."Sex_Determination_Note"'
    return f"""CASE WHEN r.sex = 'U' AND {_SEX_NEW} <> 'U' THEN {new_note}
            WHEN r.sex = 'U' AND {_SEX_NEW} = 'U' THEN coalesce({old_note}, {new_note})
            WHEN r.sex <> 'U' THEN {old_note} ELSE 'n/a' END"""


def _text(*columns: tuple[str, str]) -> str:
    return ", ".join(f"coalesce(cast({col} AS varchar), 'n/a') AS \"{name}\"" for name, col in columns)


def _number_text(col: str) -> str:
    """Whole doubles print without a fraction."""
    return f"CASE WHEN {col} = floor({col}) THEN cast(cast({col} AS bigint) AS varchar) ELSE cast({col} AS varchar) END"


_COMPLETE = _text(
    (P.RECORD_ID, "r.record_id"),
    ("Collection_ID", 'c."Collection_ID"'),
    ("Relation_To", "'rel' || cast(r.row_ord AS varchar)"),
    ("Country", 'c."Country"'),
    ("Site", 'coalesce(r.site, c."Site")'),
    ("Location", 'c."Location"'),
    ("Longitude", _number_text('c."Longitude"')),
    ("Latitude", _number_text('c."Latitude"')),
    ("Date_C14_Labnr", 'c."Date_C14_Labnr"'),
    ("Date_BC_AD_Start", 'c."Date_BC_AD_Start"'),
    ("Date_BC_AD_Stop", 'c."Date_BC_AD_Stop"'),
    ("Date_BC_AD_Median", 'c."Date_BC_AD_Median"'),
    ("Date_C14_Uncal_BP", 'c."Date_C14_Uncal_BP"'),
    ("Date_C14_Uncal_BP_Err", 'c."Date_C14_Uncal_BP_Err"'),
    ("Date_Type", 'c."Date_Type"'),
    ("Nr_Libraries", 'coalesce(r.nr_libraries, x."Nr_Libraries")'),
    ("Capture_Type", 'x."Capture_Type"'),
    ("UDG", 'coalesce(r.udg, x."UDG")'),
    ("Library_Built", 'x."Library_Built"'),
    ("Damage", _number_text('x."Damage"')),
    ("Nr_SNPs", 'x."Nr_SNPs"'),
    ("Endogenous", _number_text('x."Endogenous"')),
    ("Contamination", 'x."Contamination"'),
    ("Contamination_Err", 'x."Contamination_Err"'),
    ("Contamination_Meas", 'x."Contamination_Meas"'),
    ("Contamination_Note", 'x."Contamination_Note"'),
    ("Genetic_Sex", _SEX_NEW),
    ("Genotype_Ploidy", "coalesce(r.ploidy, 'haploid')"),
    ("Note", "cast(NULL AS varchar)"),
    ("Sex_Determination_Note", _sex_note("cast(NULL AS varchar)")),
    (P.PIPELINE_URL, f"'{Q.PIPELINE_URL}'"),
)

_KEY = "split_part(sample_key, '.', 1)"

ORACLE: dict[str, str] = {
    "sheet_clean": f"{sql('v_sheet')}, {_libs()} SELECT * FROM v_libs",
    "sheet_clean_double": f"""{sql('v_sheet')}, {_libs("WHERE strandedness = 'double'")} SELECT * FROM v_libs""",
    "sheet_summary": f"{sql('v_sheet')}, {_libs()}, {_SUMMARY} SELECT * FROM v_summary",
    "sheet_summary_packages": f"""{sql('v_sheet')}, {_libs()}
SELECT CASE strandedness WHEN 'ds' THEN 'double' ELSE 'single' END AS package_id, sample_name, count(*) AS "Nr_Libraries",
       string_agg("Seq_Type", ';' ORDER BY row_ord, "Seq_Type") AS "Capture_Type",
       CASE WHEN count(DISTINCT udg_treatment) = 1 THEN min(udg_treatment) ELSE 'mixed' END AS "UDG", min(strandedness) AS "Library_Built"
FROM v_libs GROUP BY strandedness, sample_name""",
    "code_cascade": f"""
WITH t AS (
    SELECT page_id,
           CASE page_id % 3 WHEN 0 THEN left(url, 1) WHEN 1 THEN 'X.SG' || cast(page_id AS varchar) END AS id,
           CASE WHEN page_id % 2 = 0 THEN 'TF' END AS f1, CASE WHEN page_id % 5 <> 0 THEN 'SG' END AS f2
    FROM pages)
SELECT page_id, CASE WHEN length(id) > 1 THEN {_CODE.format("substr(id, length(id) - 2, 2)")}
                     WHEN f1 IS NOT NULL THEN {_CODE.format('f1')} WHEN f2 IS NOT NULL THEN {_CODE.format('f2')} END AS capture
FROM t""",
    "recode_vocabularies": f"""{sql('v_sheet')}
SELECT library_id, row_ord, {_UDG.format('udg_treatment')} AS udg, {_BUILT.format("nullif(strandedness, 'single')")} AS built FROM v_sheet""",
    "box_classify": f"""
WITH t AS (SELECT o_orderkey, CASE WHEN o_orderkey % 9 <> 0 THEN cast(o_custkey % 130 AS double) / 100 END AS x,
                  cast(o_orderkey % 70 AS double) / 100 AS y FROM orders)
SELECT o_orderkey, {_SEX.format('x', 'y')} AS sex FROM t""",
    "hemisphere": f"SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN '{P.CURVE_NORTH}' ELSE '{P.CURVE_SOUTH}' END AS curve FROM customer",
    "key_parts": f"""{sql('v_sheet')}
SELECT library_id, row_ord, split_part(library_id, '.', 1) AS head,
       CASE WHEN contains(library_id, '.') THEN substr(library_id, strpos(library_id, '.') + 1) END AS rest,
       left(library_id, length(library_id) - 4) AS library, regexp_replace(library_id, '\\.SG1$', '') AS plain,
       regexp_replace(library_id, '[.]..[0-9]$', '') AS plain_regex, regexp_extract(r1, '[^/]*$') AS file
FROM v_sheet""",
    "mask_gate": f"""{sql('v_stats')}
SELECT sample_key, stat_ord,
       CASE WHEN x_contamination_snps < {Q.CUTOFF} THEN NULL ELSE cast(x_contamination AS double) END AS kept_if_uncounted,
       CASE WHEN x_contamination_snps >= {Q.CUTOFF} THEN cast(x_contamination AS double) END AS masked_if_uncounted,
       CASE WHEN split_part(sample_key, '.', 2) NOT IN ('', 'P1') THEN cast(x_contamination AS double) END AS gated,
       CASE WHEN sample_key <> 'Q19' THEN 'C14' END AS label, nullif(cast(filtered_mapped_reads AS double), 0) AS reads
FROM v_stats""",
    "number_text": f"""
WITH t AS (SELECT *, l_extendedprice / 16 AS x, l_tax / 16 AS t FROM lineitem)
SELECT l_orderkey, l_partkey, l_linenumber, printf('%.3f', x) AS fixed, CASE WHEN l_linenumber <> 3 THEN printf('%.3f', t) END AS small,
       {_rates(_fixed('t'), 'NULL', _fixed('x'), _fixed('l_tax'))} AS note,
       {_counts_note("coalesce(cast(nullif(l_partkey, 7) AS varchar), 'NA')", Q.CUTOFF)} AS counts
FROM t""",
    "text_clean": """
SELECT doc_id, replace(text, '"', '''') AS text, nullif(lang, 'de') AS lang, source = 'src0' OR source = '' AS no_source FROM documents""",
    "hemisphere_lenient": f"""
SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 OR c_custkey % 5 = 0 THEN NULL WHEN c_acctbal >= 0 THEN '{P.CURVE_NORTH}' ELSE '{P.CURVE_SOUTH}' END AS curve
FROM customer""",
    "strict_numbers": """
SELECT p_partkey, CASE p_partkey % 8 WHEN 2 THEN p_size * 100::DOUBLE WHEN 3 THEN p_size::DOUBLE WHEN 7 THEN p_size / 10::DOUBLE END AS number FROM part""",
    "sheet_from_text": f"{sql('v_sheet')} SELECT sample_name, library_id, strandedness, udg_treatment, r1, bam, cast(row_ord AS double) AS row_ord FROM v_sheet",
    "row_numbers": f"""{sql('v_sheet')}
SELECT sample_name, library_id, cast(row_ord AS varchar) AS row_ord, cast(row_ord % 5 AS bigint) AS part,
       row_number() OVER (PARTITION BY row_ord % 5 ORDER BY row_ord, library_id, sample_name) - 1 AS line
FROM v_sheet""",
    "records_from_text": f"""
SELECT 'I' || cast(p_partkey AS varchar) AS "{P.RECORD_ID}", CASE WHEN p_partkey % 5 <> 0 THEN p_size END AS "Nr_Libraries",
       p_brand AS "Capture_Type", CASE WHEN p_partkey % 7 <> 0 THEN cast(p_partkey AS integer) END AS "Nr_SNPs",
       p_type AS "Contamination", CASE WHEN p_partkey % 3 <> 0 THEN p_brand END AS "Contamination_Err",
       CASE WHEN p_partkey % 2 <> 0 THEN p_retailprice END AS "Coverage_on_Target_SNPs",
       cast(NULL AS varchar) AS "Contamination_Meas", cast(NULL AS varchar) AS "Contamination_Note", cast(p_partkey % 10 AS bigint) AS part,
       row_number() OVER (PARTITION BY p_partkey % 10 ORDER BY 'I' || cast(p_partkey AS varchar)) - 1 AS line
FROM part""",
    "lenient_numbers": """
SELECT p_partkey, CASE WHEN p_partkey % 4 <> 0 THEN p_size END AS whole,
       CASE p_partkey % 4 WHEN 0 THEN NULL WHEN 1 THEN p_size + cast(0.75 AS double) ELSE cast(p_size AS double) END AS number
FROM part""",
    "wmean_na": f"""{sql('v_stats')}
SELECT {_KEY} AS sample,
       CASE WHEN count(*) FILTER (x_contamination IS NOT NULL AND filtered_mapped_reads IS NULL) = 0
            THEN cast(sum(x_contamination * filtered_mapped_reads) AS double)
                 / nullif(cast(sum(filtered_mapped_reads) FILTER (x_contamination IS NOT NULL) AS double), 0) END AS mean
FROM v_stats GROUP BY {_KEY}""",
    "wmean_pairwise": f"""{sql('v_stats')}
SELECT {_KEY} AS sample, cast(sum(damage_5p1 * filtered_mapped_reads) AS double)
       / nullif(cast(sum(filtered_mapped_reads) FILTER (damage_5p1 IS NOT NULL) AS double), 0) AS mean
FROM v_stats GROUP BY {_KEY}""",
    "wmean_distinct": """
WITH t AS (SELECT l_suppkey, l_linenumber, CASE WHEN l_discount > 0.01 THEN cast(l_discount AS decimal(12,4)) END AS x,
                  cast(l_tax AS decimal(12,4)) AS y, cast(l_quantity AS decimal(12,2)) AS w FROM lineitem),
a AS (SELECT l_suppkey, cast(sum(x * w) AS double) / nullif(cast(sum(w) FILTER (x IS NOT NULL) AS double), 0) AS mean_x
      FROM (SELECT DISTINCT l_suppkey, l_linenumber, x, w FROM t) d GROUP BY l_suppkey),
b AS (SELECT l_suppkey, cast(sum(y * w) AS double) / nullif(cast(sum(w) AS double), 0) AS mean_y
      FROM (SELECT DISTINCT l_suppkey, l_linenumber, y, w FROM t) d GROUP BY l_suppkey)
SELECT l_suppkey, mean_x, mean_y FROM a JOIN b USING (l_suppkey)""",
    "collapse_mixed": f"""{sql('v_sheet')}
SELECT sample_name,
       CASE WHEN count(udg_treatment) = 0 THEN NULL WHEN count(DISTINCT coalesce(udg_treatment, '?')) = 1 THEN min(udg_treatment) ELSE 'mixed' END AS udg,
       CASE WHEN count(DISTINCT coalesce(udg_treatment, 'NA')) = 1 THEN min(coalesce(udg_treatment, 'NA')) ELSE 'mixed' END AS udg_of_list
FROM v_sheet GROUP BY sample_name""",
    "concat_ordered": f"""{sql('v_sheet')}
SELECT sample_name, string_agg(coalesce(udg_treatment, 'NA'), ';' ORDER BY row_ord, coalesce(udg_treatment, 'NA')) AS treatments,
       string_agg(library_id, ';' ORDER BY row_ord, library_id) AS libraries
FROM v_sheet GROUP BY sample_name""",
    "concat_ordered_any": f"""{sql('v_sheet')}
SELECT run, string_agg(library_id, ';' ORDER BY place NULLS FIRST, library_id) AS libraries,
       string_agg(coalesce(udg_treatment, 'NA'), ';' ORDER BY coalesce(udg_treatment, 'NA')) FILTER (place IS NULL) AS treatments, count(*) AS n
FROM (SELECT substr(r1, 1, 7) AS run, library_id, udg_treatment, CASE row_ord % 3 WHEN 0 THEN row_ord WHEN 1 THEN 7 END AS place FROM v_sheet)
GROUP BY run""",
    "concat_distinct_ordered": f"""{sql('v_sheet')}
SELECT sample_name, string_agg(v, ';' ORDER BY place, v) AS treatments
FROM (SELECT sample_name, coalesce(udg_treatment, 'NA') AS v, min(row_ord) AS place FROM v_sheet GROUP BY ALL) t GROUP BY sample_name""",
    "concat_distinct_pairs": """
SELECT l_orderkey, string_agg(v, ';' ORDER BY place, v) AS quantities
FROM (SELECT l_orderkey, l_returnflag, cast(cast(l_quantity AS bigint) AS varchar) AS v, min(l_partkey * 8 + l_linenumber) AS place
      FROM lineitem GROUP BY ALL) t GROUP BY l_orderkey""",
    "first_valid": """
SELECT user_id, arg_min(value, event_id) FILTER (event_type <> 'click') AS first_value,
       arg_min(event_type, event_id) FILTER (value > 5) AS first_type
FROM events GROUP BY user_id""",
    "max_strict": """
SELECT l_orderkey, CASE WHEN count(*) FILTER (l_suppkey % 9 = 0) = 0 THEN max(l_extendedprice) END AS top FROM lineitem GROUP BY l_orderkey""",
    "max_valid": f"""{sql('v_sheet')}
SELECT sample_name, max(row_ord) FILTER (udg_treatment IS NOT NULL) AS last_treated FROM v_sheet GROUP BY sample_name""",
    "count_distinct_null": f"""{sql('v_sheet')}
SELECT sample_name, count(DISTINCT coalesce(udg_treatment, '?')) AS n_treatments, count(*) AS n_rows FROM v_sheet GROUP BY sample_name""",
    "repeat_label": """
SELECT l_orderkey, string_agg('1240K', ';') AS labels, cast(NULL AS varchar) AS "none" FROM lineitem GROUP BY l_orderkey""",
    "members": f"""{sql('v_sheet', 'v_stats')}
SELECT sample_key, stat_ord, sexdet_rate_y FROM v_stats
WHERE sample_key IN (SELECT sample_name FROM v_sheet) OR sample_key IN (SELECT library_id FROM v_sheet)""",
    "grain_resolve": f"""{sql('v_sheet', 'v_stats')}, {_libs()}
SELECT coalesce(sample_name, sample_key) AS sample_name, count(*) FILTER (library_id IS NOT NULL) AS n_units,
       count(*) FILTER (library_id IS NULL) AS n_loose, count(stat_ord) AS n_stats, max(coalesce(covered_snps, x_contamination_snps)) AS snps
FROM v_libs FULL JOIN v_stats ON library_id = sample_key GROUP BY 1""",
    "facet_merge": f"""{sql('v_sheet')}, {_libs()}
SELECT sample_name, nullif(count(*) FILTER ("Seq_Type" = 'Shotgun'), 0) AS n_shotgun,
       max(row_ord) FILTER (udg_treatment = 'plus') AS last_plus, min(row_ord) FILTER (strandedness = 'ss') AS first_single
FROM v_libs GROUP BY sample_name
HAVING n_shotgun IS NOT NULL OR last_plus IS NOT NULL OR first_single IS NOT NULL""",
    "facet_merge_duplicates": """
WITH a AS (SELECT nullif(s_suppkey // 2, 3) AS k, s_name AS a FROM supplier),
b AS (SELECT nullif(c_custkey // 3, 3) AS k, c_name AS b FROM customer),
c AS (SELECT CASE WHEN n_nationkey % 5 <> 0 THEN n_regionkey END AS k, n_name AS c FROM nation),
two AS (SELECT coalesce(a.k, b.k) AS k, a, b FROM a FULL JOIN b ON a.k IS NOT DISTINCT FROM b.k)
SELECT k, a, b, NULL::VARCHAR AS c, 2 AS n FROM two
UNION ALL SELECT coalesce(two.k, c.k), a, b, c, 3 FROM two FULL JOIN c ON two.k IS NOT DISTINCT FROM c.k""",
    "chain_context_guarded": f"{sql('v_records')}, {_IDS.format('record_id')}, {_CHAIN}, {_CONTEXT} SELECT * FROM v_found",
    "chain_context": f"{sql('v_records')}, {_IDS.format('record_id')}, {_CHAIN}, {_CONTEXT} SELECT * FROM v_found",
    "facets_endogenous": _facts('SELECT sample_name, "Endogenous" FROM v_facts'),
    "facets_contamination": _facts(
        'SELECT sample_name, "Contamination", "Contamination_Err", "Contamination_Meas", "Contamination_Note",'
        " contamination_mean, contamination_err_mean FROM v_facts"
    ),
    "facets_sex": _facts('SELECT sample_name, "Genetic_Sex", "Sex_Determination_Note", "Damage", "Nr_SNPs" FROM v_facts'),
    "run_import": _facts(f"SELECT {_NO_MEANS} FROM v_facts"),
    "run_import_any": _facts(f"SELECT {_NO_MEANS} FROM v_facts"),
    "run_import_single": _facts(f"SELECT {_NO_MEANS} FROM v_facts", where="WHERE strandedness = 'single'"),
    "run_import_unplaced": _facts(
        'SELECT sample_name, "Nr_Libraries", "Library_Built", "Endogenous", "Damage", "Nr_SNPs", "Contamination", "Contamination_Err" FROM v_facts'
    ),
    "schema_upgrade": f"""
SELECT 'I' || cast(p_partkey AS varchar) AS "{P.RECORD_ID}", CASE WHEN p_partkey % 5 <> 0 THEN p_size END AS "Nr_Libraries",
       p_brand AS "Capture_Type", CASE WHEN p_partkey % 7 <> 0 THEN cast(p_partkey AS integer) END AS "Nr_SNPs",
       p_type AS "Contamination", CASE WHEN p_partkey % 3 <> 0 THEN p_brand END AS "Contamination_Err",
       CASE WHEN p_partkey % 2 <> 0 THEN p_retailprice END AS "Coverage_on_Target_SNPs",
       cast(NULL AS varchar) AS "Contamination_Meas", cast(NULL AS varchar) AS "Contamination_Note"
FROM part""",
    "collate": _facts(
        f"""SELECT coalesce(i."{P.RECORD_ID}", x.sample_name) AS "{P.RECORD_ID}", "Site", "Country", "Location", "Date_C14_Labnr",
       "Date_BC_AD_Start", "Nr_Libraries", "Capture_Type", "Genetic_Sex"
FROM (v_ids LEFT JOIN v_found USING (context_id)) i FULL JOIN v_facts x ON i."{P.RECORD_ID}" = x.sample_name""",
        "v_records",
        extra=f""",\n{_IDS.format("regexp_replace(record_id, '9$', '')")}, {_CHAIN}, {_CONTEXT}""",
    ),
    "fill_missing": f"""{sql('v_sheet', 'v_records')}, {_libs()}, {_SUMMARY}
SELECT row_ord, record_id, site, coalesce(r.nr_libraries, s."Nr_Libraries") AS nr_libraries, coalesce(r.udg, s."UDG") AS udg, sex,
       coalesce(ploidy, 'diploid') AS ploidy, "Library_Built"
FROM v_records r FULL JOIN v_summary s ON r.record_id = s.sample_name""",
    "linked_fill": _facts(
        f"""SELECT coalesce(r.record_id, x.sample_name) AS record_id, r.sex AS old_sex, {_SEX_NEW} AS sex,
       {_sex_note("CASE WHEN r.row_ord % 8 < 4 THEN 'kept' END")} AS note FROM {_FILL_JOIN}""",
        "v_records",
    ),
    "change_report": _facts(
        f"""SELECT coalesce(r.record_id, x.sample_name) AS record_id, r.sex AS old, {_SEX_NEW} AS new FROM {_FILL_JOIN}
WHERE r.sex IS DISTINCT FROM {_SEX_NEW}""",
        "v_records",
    ),
    "duplicate_keys": """
SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "render_records": f"""
SELECT cast(o_orderkey AS varchar) AS o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderpriority ELSE 'n/a' END AS priority,
       CASE WHEN o_orderkey % 4 <> 0 THEN cast(cast(floor(o_totalprice) AS bigint) AS varchar) ELSE 'n/a' END AS price,
       {_number_text('(o_custkey / cast(8 AS double))')} AS share
FROM orders""",
    "fill_records": _facts(
        f"""SELECT r.record_id AS "{P.RECORD_ID}", 'rel' || cast(r.row_ord AS varchar) AS "Relation_To", r.site AS "Site",
       cast(coalesce(r.nr_libraries, x."Nr_Libraries") AS integer) AS "Nr_Libraries", "Capture_Type", coalesce(r.udg, x."UDG") AS "UDG",
       "Library_Built", {_SEX_NEW} AS "Genetic_Sex", coalesce(r.ploidy, 'haploid') AS "Genotype_Ploidy", cast(NULL AS varchar) AS "Note",
       {_sex_note("cast(NULL AS varchar)")} AS "Sex_Determination_Note", '{Q.PIPELINE_URL}' AS "{P.PIPELINE_URL}"
FROM {_FILL_JOIN}""",
        "v_records",
    ),
    "complete_records": _facts(
        f"SELECT {_COMPLETE} FROM {_FILL_JOIN} LEFT JOIN v_found c ON c.context_id = r.record_id",
        "v_records",
        extra=f",\n{_IDS.format('record_id')}, {_CHAIN}, {_CONTEXT}",
    ),
    "completion_counts": _facts(
        f"""SELECT count(*) AS rows, count(*) FILTER (r.record_id IS NULL) AS unlisted, cast(0 AS bigint) AS unmatched, cast(0 AS bigint) AS repeated,
       count(*) FILTER (r.sex IS DISTINCT FROM {_SEX_NEW}) AS changed FROM {_FILL_JOIN}""",
        "v_records",
    ),
    "completion_changes": _facts(
        f"""SELECT coalesce(r.record_id, x.sample_name) AS "{P.RECORD_ID}", r.sex AS old, {_SEX_NEW} AS new FROM {_FILL_JOIN}
WHERE r.sex IS DISTINCT FROM {_SEX_NEW}""",
        "v_records",
    ),
    "compile_units": f"{sql('v_sheet', 'v_tools')}, {_compiled()} SELECT * EXCLUDE (est, se) FROM v_units",
    "compile_units_partial": f"{sql('v_sheet', 'v_tools')}, {_compiled(True)} SELECT * EXCLUDE (est, se) FROM v_units",
    "rollup_units": f"{sql('v_sheet', 'v_tools')}, {_compiled()}, {_ROLLUP}",
    "rollup_units_any": f"{sql('v_sheet', 'v_tools')}, {_compiled()}, {_ROLLUP}",
    "rollup_unplaced": f"""{sql('v_sheet', 'v_tools')}, {_compiled()}, {_ROLLUP.replace("SELECT u.sample_name", ", v_done AS (SELECT u.sample_name", 1)})
SELECT sample_name, library_id, "Contamination", "Contamination_Err", "Contamination_Meas", "Damage", "Endogenous" FROM v_done""",
    "compile_units_pre": f"{sql('v_sheet', 'v_tools')}, {_compiled()} SELECT sample_name, library_id, row_ord, \"Endogenous\" / 2 AS \"Endogenous\" FROM v_units",
    "calibrate_outside": f"""
WITH v_asked AS (
    SELECT c_custkey, cast(c_custkey % 40 * 97 - 500 AS integer) AS age,
           cast(CASE WHEN c_custkey % 50 = 7 THEN 1000000000 ELSE c_custkey % 9 * 4 + 2 END AS integer) AS error,
           CASE WHEN c_custkey % 2 = 0 THEN '{P.CURVE_NORTH}' ELSE '{P.CURVE_SOUTH}' END AS curve FROM customer),
{_CURVE}, {_calibrated('v_asked')}
SELECT v_asked.*, "Date_BC_AD_Median", "Date_BC_AD_Start_1Sigma", "Date_BC_AD_Stop_1Sigma", "Date_BC_AD_Start_2Sigma", "Date_BC_AD_Stop_2Sigma"
FROM v_asked LEFT JOIN v_cal USING (curve, age, error)""",
    "calibrate_batch": f"""
WITH v_asked AS (
    SELECT o_orderkey, CASE WHEN o_orderkey % 11 <> 0 THEN cast(o_custkey % 1500 + 200 AS integer) END AS age,
           cast(o_orderkey % 16 + 5 AS integer) AS error,
           CASE WHEN o_orderkey % 2 = 0 THEN '{P.CURVE_NORTH}' ELSE '{P.CURVE_SOUTH}' END AS curve FROM orders),
{_CURVE}, {_calibrated('v_asked')}
SELECT v_asked.*, "Date_BC_AD_Median", "Date_BC_AD_Start_1Sigma", "Date_BC_AD_Stop_1Sigma", "Date_BC_AD_Start_2Sigma", "Date_BC_AD_Stop_2Sigma"
FROM v_asked LEFT JOIN v_cal USING (curve, age, error)""",
    "context_calibrated": f"""{sql('v_records')}, {_IDS.format('record_id')}, {_CHAIN},
v_asked AS (
    SELECT id, lab, info, CASE WHEN lab IS NOT NULL THEN d_from END AS d_from, CASE WHEN lab IS NOT NULL THEN d_to END AS d_to,
           CASE WHEN lab IS NOT NULL THEN age END AS age, CASE WHEN lab IS NOT NULL THEN error END AS error,
           CASE WHEN lat >= 0 THEN '{P.CURVE_NORTH}' ELSE '{P.CURVE_SOUTH}' END AS curve
    FROM v_chain WHERE id IN (SELECT context_id FROM v_ids)),
{_CURVE}, {_calibrated('v_asked')}
SELECT id AS context_id, coalesce(d_from, "Date_BC_AD_Start_2Sigma") AS "Date_BC_AD_Start", coalesce(d_to, "Date_BC_AD_Stop_2Sigma") AS "Date_BC_AD_Stop",
       "Date_BC_AD_Median", age AS "Date_C14_Uncal_BP", error AS "Date_C14_Uncal_BP_Err", CASE WHEN lab IS NOT NULL THEN 'C14' END AS "Date_Type",
       CASE WHEN lab IS NOT NULL THEN coalesce(info, '{P.DATE_NOTE_CALIBRATED}') END AS "Date_Note"
FROM v_asked LEFT JOIN v_cal USING (curve, age, error)""",
}
