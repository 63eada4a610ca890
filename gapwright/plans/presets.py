"""Column names, vocabularies, cutoffs and note texts of the input and output formats.

Everything here must equal the formats it describes, so it is stated plainly and in one place. The
operators take names as arguments; only the jobs use these as defaults.
"""

from __future__ import annotations

# --- vocabularies (raw value -> record value) and the label of everything else
CAPTURE_TYPES = {"SG": "Shotgun", "TF": "1240K"}
CAPTURE_OTHER = "OtherCapture"
LIBRARY_BUILDS = {"single": "ss", "double": "ds"}
LIBRARY_BUILD_OTHER = "other"
UDG_TREATMENTS = {"none": "minus", "half": "half", "full": "plus"}
UDG_OTHER = "mixed"
CAPTURE_CHOICES = ("Shotgun", "1240K", "OtherCapture", "ReferenceGenome")
KEEP_ONLY_CHOICES = ("none", "single", "double")
PLOIDY_CHOICES = ("haploid", "diploid")
CONTAMINATION_METHODS = ("1", "2")
CONTAMINATION_ALGORITHMS = ("ml", "mom")

# --- sex call from relative coverage: (x_lo, x_hi, y_lo, y_hi), bounds inclusive
XX_BOX = (0.7, 1.2, 0.0, 0.1)
XY_BOX = (0.2, 0.6, 0.3, 0.6)
SEX_UNKNOWN = "U"


def sex_boxes(xx=XX_BOX, xy=XY_BOX):
    return [("F", xx), ("M", xy)]


# --- other constants
SNP_CUTOFF = 100
CONTAMINATION_METHOD_NAME = "ANGSD"
CURVE_NORTH = "intcal20"
CURVE_SOUTH = "shcal20"
DATE_TYPE = "C14"
DATE_NOTE_CALIBRATED = "quickcalibration from Date_C14_Uncal_BP and Date_C14_Uncal_BP_Err"
MISSING_TEXT = "n/a"
STATS_MISSING = ("", "N/A", "NA")
SHEET_MISSING = ("", "NA")
SHEET_TYPES = "cciiccccccc"

# --- wide QC table: alias -> source column
STATS_KEY = "Sample"
STATS_COLUMNS = {
    "sexdet_err_x": "SexDetErrmine_mqc-generalstats-sexdeterrmine-RateErrX",
    "sexdet_err_y": "SexDetErrmine_mqc-generalstats-sexdeterrmine-RateErrY",
    "sexdet_rate_x": "SexDetErrmine_mqc-generalstats-sexdeterrmine-RateX",
    "sexdet_rate_y": "SexDetErrmine_mqc-generalstats-sexdeterrmine-RateY",
    "endogenous_dna": "endorSpy_mqc-generalstats-endorspy-endogenous_dna",
    "covered_snps": "snp_coverage_mqc-generalstats-snp_coverage-Covered_Snps",
    "damage_5p1": "DamageProfiler_mqc-generalstats-damageprofiler-5_Prime1",
    "x_contamination_snps": "nuclear_contamination_mqc-generalstats-nuclear_contamination-Num_SNPs",
    "x_contamination": "nuclear_contamination_mqc-generalstats-nuclear_contamination-Method1_ML_estimate",
    "x_contamination_error": "nuclear_contamination_mqc-generalstats-nuclear_contamination-Method1_ML_SE",
    "filtered_mapped_reads": (
        "Samtools Flagstat (post-samtools filter)_mqc-generalstats-"
        "samtools_flagstat_post_samtools_filter-mapped_passed"
    ),
}

# --- record table. The id column's name belongs to the caller's format; this is only a default.
RECORD_ID = "Record_ID"
OLD_RECORD_ID = "Individual_ID"
RECORD_INTS = [
    "Date_C14_Uncal_BP",
    "Date_C14_Uncal_BP_Err",
    "Date_BC_AD_Median",
    "Date_BC_AD_Start",
    "Date_BC_AD_Stop",
    "No_of_Libraries",
    "Nr_autosomal_SNPs",
    "Nr_Libraries",
    "Nr_SNPs",
]
RECORD_DOUBLES = [
    "Latitude",
    "Longitude",
    "Coverage_1240K",
    "Endogenous_DNA",
    "Damage",
    "Endogenous",
    "Coverage_on_Target_SNPs",
]
OLD_RENAMES = {
    "No_of_Libraries": "Nr_Libraries",
    "Data_Type": "Capture_Type",
    "Nr_autosomal_SNPs": "Nr_SNPs",
    "Xcontam": "Contamination",
    "Xcontam_stderr": "Contamination_Err",
    "Coverage_1240K": "Coverage_on_Target_SNPs",
}
OLD_ADDED = {"Contamination_Meas": "string", "Contamination_Note": "string"}

# Columns that are filled, with their types, in output order.
FILLED = {
    "Collection_ID": "string",
    "Country": "string",
    "Site": "string",
    "Location": "string",
    "Longitude": "double",
    "Latitude": "double",
    "Date_C14_Labnr": "string",
    "Date_BC_AD_Start": "int",
    "Date_BC_AD_Stop": "int",
    "Date_BC_AD_Median": "int",
    "Date_C14_Uncal_BP": "int",
    "Date_C14_Uncal_BP_Err": "int",
    "Date_Type": "string",
    "Nr_Libraries": "int",
    "Capture_Type": "string",
    "UDG": "string",
    "Library_Built": "string",
    "Damage": "double",
    "Nr_SNPs": "int",
    "Endogenous": "double",
    "Contamination": "string",
    "Contamination_Err": "string",
    "Contamination_Meas": "string",
    "Contamination_Note": "string",
}
# Further record columns that the output keeps, behind the filled ones.
KEPT = [
    "Alternative_IDs",
    "Group_Name",
    "Genetic_Sex",
    "MT_Haplogroup",
    "Y_Haplogroup",
    "Source_Tissue",
    "Genotype_Ploidy",
    "Coverage_on_Target_SNPs",
    "Genetic_Source_Accession_IDs",
    "Primary_Contact",
    "Publication",
    "Note",
]
RELATION_PREFIX = "Relation_"
SEX = "Genetic_Sex"
SEX_NOTE = "Sex_Determination_Note"
PLOIDY = "Genotype_Ploidy"
PIPELINE_URL = "Data_Preparation_Pipeline_URL"

# --- relational context: prefixes of the two tables that matter, and the record columns from them
CONTEXT_PREFIXES = ("site.", "individual.")
CONTEXT_KEY = "individual.Full_Individual_Id"
CONTEXT_COLUMNS = [
    "Collection_ID",
    "Country",
    "Site",
    "Location",
    "Longitude",
    "Latitude",
    "Date_C14_Labnr",
    "Date_BC_AD_Start",
    "Date_BC_AD_Stop",
    "Date_BC_AD_Median",
    "Date_C14_Uncal_BP",
    "Date_C14_Uncal_BP_Err",
    "Date_Type",
    "Date_Note",
]
