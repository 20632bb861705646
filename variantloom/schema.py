"""Canonical association schema, header aliases and fixed vocabulary."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Population labels and labels of combined analyses.
SUPERPOPULATIONS = ("EUR", "AFR", "EAS", "SAS", "AMR")
MULTI = "MULTI"
UNKNOWN_POPULATION = "UNKNOWN"
UNMAPPED_POPULATION = "UNMAPPED"
COMBINED_PUBLISHED = "COMBINED_PUBLISHED"
COMBINED_META = "COMBINED_META"

# The chromosomes analysed by default.
AUTOSOMES = tuple(str(number) for number in range(1, 23))

# Canonical association columns in export order.
SUMSTATS_SCHEMA = T.StructType(
    [
        T.StructField("STUDY_ID", T.StringType()),
        T.StructField("TRAIT", T.StringType()),
        T.StructField("POPULATION", T.StringType()),
        T.StructField("CHR", T.StringType()),
        T.StructField("POS", T.LongType()),
        T.StructField("RSID", T.StringType()),
        T.StructField("REF", T.StringType()),
        T.StructField("ALT", T.StringType()),
        T.StructField("EA", T.StringType()),
        T.StructField("NEA", T.StringType()),
        T.StructField("BETA", T.DoubleType()),
        T.StructField("SE", T.DoubleType()),
        T.StructField("OR", T.DoubleType()),
        T.StructField("Z", T.DoubleType()),
        T.StructField("P", T.DoubleType()),
        T.StructField("NEG_LOG10_P", T.DoubleType()),
        T.StructField("EAF", T.DoubleType()),
        T.StructField("N", T.DoubleType()),
        T.StructField("N_CASES", T.DoubleType()),
        T.StructField("N_CONTROLS", T.DoubleType()),
        T.StructField("N_EFF", T.DoubleType()),
        T.StructField("BUILD", T.StringType()),
        T.StructField("SOURCE_FILE", T.StringType()),
        T.StructField("VARIANT_ID", T.StringType()),
    ]
)
SUMSTATS_COLUMNS = tuple(SUMSTATS_SCHEMA.names)

# Recognised lower-case headers per canonical field, in priority
# order (a field takes the first alias present; a header serves one field).
COLUMN_ALIASES: dict[str, tuple[str, ...]] = {
    "CHR": ("hm_chrom", "chromosome", "chrom", "chr", "#chrom", "#chr", "chromosome_name", "ch"),
    "POS": ("hm_pos", "base_pair_location", "pos", "bp", "position", "base_pair", "genpos", "bp_hg38", "pos_b38"),
    "RSID": ("hm_rsid", "rsid", "rs_id", "snp", "markername", "variant_id", "snpid", "rsids", "id"),
    "EA": ("hm_effect_allele", "effect_allele", "ea", "a1", "alt", "allele1", "tested_allele", "effectallele"),
    "NEA": (
        "hm_other_allele", "other_allele", "nea", "a2", "ref", "allele0", "allele2", "non_effect_allele",
        "otherallele",
    ),
    "BETA": ("hm_beta", "beta", "b", "effect", "log_odds", "logor", "effect_size", "beta_fixed"),
    "OR": ("hm_odds_ratio", "odds_ratio", "or"),
    "OR_L95": ("hm_ci_lower", "ci_lower", "or_95l", "lower_ci", "or_l95"),
    "OR_U95": ("hm_ci_upper", "ci_upper", "or_95u", "upper_ci", "or_u95"),
    "SE": ("standard_error", "se", "stderr", "sebeta", "se_beta", "standard_error_of_beta", "se_fixed"),
    "Z": ("z", "zscore", "z_score", "zstat", "z_stat"),
    "P": (
        "p_value", "p", "pval", "pvalue", "p-value", "p.value", "p_bolt_lmm", "p_fixed", "p_value_nominal",
    ),
    "NEG_LOG10_P": ("neg_log_10_p_value", "neg_log10_p", "log10p", "mlog10p", "minus_log10_pval", "lp"),
    "EAF": (
        "hm_effect_allele_frequency", "effect_allele_frequency", "eaf", "af", "freq", "af_alt", "a1freq",
        "maf_effect", "frq", "freq1",
    ),
    "N": ("n", "n_total", "sample_size", "neff", "n_samples", "totalsamplesize", "nobs"),
    "N_CASES": ("n_cases", "ncase", "n_case", "cases", "num_cases"),
    "N_CONTROLS": ("n_controls", "ncontrol", "n_control", "controls", "num_controls"),
    "INFO": ("info", "imputation_score", "r2", "rsq", "impinfo"),
}
REQUIRED_FIELDS = ("CHR", "POS", "EA", "NEA")


def map_columns(header: Iterable[str]) -> dict[str, str]:
    """Canonical field -> source header; first alias wins, a header is used once."""
    available = {name.strip().lower(): name for name in header}
    mapping: dict[str, str] = {}
    for field, aliases in COLUMN_ALIASES.items():
        alias = next((a for a in aliases if a in available), None)
        if alias is not None:
            mapping[field] = available.pop(alias)
    return mapping


def capabilities(fields: Iterable[str]) -> dict[str, bool]:
    """What a mapped header can support, from the canonical fields it provides."""
    have = set(fields)
    return {
        "has_alleles": {"EA", "NEA"} <= have,
        "has_beta": "BETA" in have,
        "has_or": "OR" in have,
        "has_se": "SE" in have or {"OR_L95", "OR_U95"} <= have,
        "has_eaf": "EAF" in have,
        "has_n": "N" in have,
        "has_p": bool({"P", "NEG_LOG10_P"} & have),
    }


def header_capabilities(files: DataFrame, header: str = "header_columns") -> DataFrame:
    """The same flags for a table of files that each carry a header array.

    ``map_columns`` decides on a driver-side header; here the decision is array
    containment so that a table of any size stays distributed.
    """
    lowered = F.transform(F.col(header), lambda name: F.lower(F.trim(name)))

    def has(field: str):
        return F.arrays_overlap(lowered, F.array(*[F.lit(alias) for alias in COLUMN_ALIASES[field]]))

    return files.select(
        "*",
        (has("EA") & has("NEA")).alias("has_alleles"),
        has("BETA").alias("has_beta"),
        has("OR").alias("has_or"),
        (has("SE") | (has("OR_L95") & has("OR_U95"))).alias("has_se"),
        has("EAF").alias("has_eaf"),
        has("N").alias("has_n"),
        (has("P") | has("NEG_LOG10_P")).alias("has_p"),
    )


def validate(df: DataFrame) -> list[str]:
    """Missing columns, then columns of the wrong type."""
    actual = {field.name: field.dataType for field in df.schema}
    problems = [f"missing column {name}" for name in SUMSTATS_COLUMNS if name not in actual]
    for field in SUMSTATS_SCHEMA:
        found = actual.get(field.name)
        if found is not None and found != field.dataType:
            problems.append(
                f"{field.name} has type {found.simpleString()}, expected {field.dataType.simpleString()}"
            )
    return problems


def empty_table(spark: SparkSession, schema: T.StructType | str = SUMSTATS_SCHEMA) -> DataFrame:
    return spark.createDataFrame([], schema)


def canonical_projection(
    df: DataFrame, constants: Mapping[str, object] | None = None, extra: Iterable[str] = ()
) -> DataFrame:
    """All canonical columns in order, cast; absent ones are constants or null."""
    constants = constants or {}
    present = set(df.columns)
    out = []
    for field in SUMSTATS_SCHEMA:
        if field.name in constants:
            value = constants[field.name]
            column = value if hasattr(value, "alias") else F.lit(value)
        else:
            column = F.col(field.name) if field.name in present else F.lit(None)
        out.append(column.cast(field.dataType).alias(field.name))
    return df.select(*out, *extra)
