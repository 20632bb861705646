"""Raw association rows to the canonical, quality-controlled table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from variantloom.functions import statistics as S
from variantloom.functions import tails
from variantloom.functions import variants as V
from variantloom.plans.ordered import bind, exact_median
from variantloom.session import checkpointed
from variantloom.schema import (
    AUTOSOMES,
    COMBINED_PUBLISHED,
    MULTI,
    SUPERPOPULATIONS,
    canonical_projection,
)

GENOME_WIDE = 5e-8


class AggregatedSplitError(ValueError):
    """Multi-population statistics were about to be used as one population's."""


class BuildMismatchError(RuntimeError):
    """Too few alleles agree with the reference sequence."""


class OddsRatioAsBetaError(ValueError):
    """A column mapped to BETA looks like an odds ratio."""


def _optional(value: float | Column | None) -> Column:
    return value.cast("double") if isinstance(value, Column) else F.lit(value).cast("double")


def label_violation(population: str = "population", label: str = "analysis_label") -> Column:
    """Why an analysis label may not be used for a population; null when it may."""
    pop, lab = F.col(population), F.col(label)
    return F.when(
        (pop == MULTI) & ~lab.eqNullSafe(COMBINED_PUBLISHED),
        F.concat(F.lit("multi-population statistics cannot be analysed as "), F.coalesce(lab, F.lit("null"))),
    ).when(
        lab.isin(*SUPERPOPULATIONS) & ~lab.eqNullSafe(pop),
        F.concat(F.lit("label "), lab, F.lit(" does not match population "), F.coalesce(pop, F.lit("null"))),
    )


def guard_population_label(analyses: DataFrame, strict: bool = True) -> DataFrame:
    """Add LABEL_VIOLATION; in strict use any violation fails the job."""
    reason = label_violation()
    if strict:
        reason = F.when(reason.isNotNull(), F.raise_error(reason)).otherwise(F.lit(None).cast("string"))
    return analyses.withColumn("LABEL_VIOLATION", reason)


def check_label(population: str | None, label: str | None) -> str | None:
    """Driver-side form of the guard for a single analysis."""
    if population == MULTI:
        if label != COMBINED_PUBLISHED:
            raise AggregatedSplitError(f"multi-population statistics cannot be analysed as {label!r}")
    elif label in SUPERPOPULATIONS and population != label:
        raise AggregatedSplitError(f"label {label} does not match population {population}")
    return label


def derive_statistics(
    raw: DataFrame,
    n_cases: float | Column | None = None,
    n_controls: float | Column | None = None,
    n_total: float | Column | None = None,
    ci_only_with_odds: bool = True,
) -> DataFrame:
    """Lenient casts, normalised alleles and derived effect, error, Z, P and sizes.

    ``raw`` has canonical names and text (or typed) values.  Study-level sizes
    may be constants or columns of the row's study.  Unknown sizes stay null.
    A confidence interval gives SE only where the odds ratio is the effect,
    unless ``ci_only_with_odds`` is off.
    """
    types = dict(raw.dtypes)

    def num(name: str) -> Column:
        if types.get(name) == "string":
            return V.number(name)
        return (F.col(name) if name in types else F.lit(None)).cast("double")

    def text(name: str) -> Column:
        return F.col(name).cast("string") if name in types else F.lit(None).cast("string")

    made = {
        "CHR": V.norm_chr(text("CHR")),
        "POS": num("POS").try_cast("bigint"),
        "RSID": F.when(text("RSID").rlike(r"^rs\d+$"), text("RSID")),
        "EA": V.norm_allele(text("EA")),
        "NEA": V.norm_allele(text("NEA")),
        "BETA_IN": num("BETA"),
        "SE_IN": num("SE"),
        "OR": num("OR"),
        "OR_L95": num("OR_L95"),
        "OR_U95": num("OR_U95"),
        "EAF": num("EAF"),
        "N_IN": num("N"),
        "N_CASES": F.coalesce(num("N_CASES"), _optional(n_cases)),
        "N_CONTROLS": F.coalesce(num("N_CONTROLS"), _optional(n_controls)),
        "N_TOTAL": _optional(n_total),
        "P_IN": num("P"),
        "NLP_IN": num("NEG_LOG10_P"),
        "Z_IN": num("Z"),
        "INFO": num("INFO"),
    }
    replaced = {*made, "BETA", "SE", "N", "P", "NEG_LOG10_P", "Z", "N_EFF"}
    carried = [name for name in raw.columns if name not in replaced]
    cast = bind(raw.select("*"), made)
    ci = S.se_from_ci(F.col("OR_L95"), F.col("OR_U95"))
    if ci_only_with_odds:
        ci = F.when(F.col("BETA_IN").isNull(), ci)
    beta, se = F.coalesce("BETA_IN", S.log_odds(F.col("OR"))), F.coalesce("SE_IN", ci)
    z = S.z_score(beta, se, F.col("Z_IN"))
    # A tail of Z always lies in [0, 1]; only reported values can be out of range.
    in_range = F.coalesce(F.col("P_IN").between(0.0, 1.0), F.col("NLP_IN") >= 0, z.isNotNull() & ~F.isnan(z))
    same = ["CHR", "POS", "RSID", "EA", "NEA"]
    effects = cast.select(
        *carried, *same, beta.alias("BETA"), se.alias("SE"), "OR", z.alias("Z"), "EAF",
        F.coalesce("N_IN", F.col("N_CASES") + F.col("N_CONTROLS"), "N_TOTAL").alias("N"), "N_CASES", "N_CONTROLS",
        S.effective_n("N_CASES", "N_CONTROLS").alias("N_EFF"), "INFO", "P_IN", "NLP_IN",
        in_range.alias("P_IN_RANGE"), tails.tail_argument(z).alias("_TAIL_AT"),
    )
    kept = [name for name in effects.columns if name not in {"P_IN", "NLP_IN", "_TAIL_AT"}]
    tailed = effects.select(*kept, "P_IN", "NLP_IN", tails.log_tail_of("_TAIL_AT", "Z").alias("_LOG_TAIL"))
    p = S.p_value(F.col("P_IN"), F.col("NLP_IN"), F.col("_LOG_TAIL"))
    return tailed.select(
        *kept, p.alias("P"), S.neg_log10_p(F.col("NLP_IN"), p, F.col("_LOG_TAIL")).alias("NEG_LOG10_P")
    )


def qc_condition(
    chromosomes: Sequence[str] = AUTOSOMES, min_info: float | None = None, p_in_range: Column | None = None
) -> Column:
    """Row filter of the quality control; a null condition counts as failed.

    ``p_in_range`` replaces the test of P where a cheaper equivalent is known:
    the optimizer pushes this filter below the derivation, and a test of P would
    take the whole normal tail along with it.
    """
    keep = (
        F.col("CHR").isin(*chromosomes)
        & (F.col("POS") > 0)
        & V.is_valid_dna("EA")
        & V.is_valid_dna("NEA")
        & (F.col("EA") != F.col("NEA"))
        & S.is_finite("BETA")
        & S.is_finite("SE")
        & (F.col("SE") > 0)
        & (F.col("P").between(0.0, 1.0) if p_in_range is None else p_in_range)
        & (F.col("EAF").isNull() | F.col("EAF").between(0.0, 1.0))
    )
    if min_info is not None:
        keep = keep & (F.col("INFO").isNull() | (F.col("INFO") >= min_info))
    return keep


def apply_qc(df: DataFrame, chromosomes: Sequence[str] = AUTOSOMES, min_info: float | None = None) -> DataFrame:
    if "P_IN_RANGE" in df.columns:
        return df.filter(qc_condition(chromosomes, min_info, F.col("P_IN_RANGE"))).drop("P_IN_RANGE")
    return df.filter(qc_condition(chromosomes, min_info))


def keep_strongest(
    df: DataFrame,
    keys: Sequence[str],
    ties: Sequence[str] = ("EA", "NEA", "SOURCE_FILE", "BETA", "SE", "EAF", "N", "N_CASES", "N_CONTROLS"),
) -> DataFrame:
    """One row per key, smallest P first, with explicit tie-breakers.

    ``row_number() = 1`` is pruned on the map side (window group limit), so a
    hot key sends one row per task through the shuffle.  A hash of the key comes
    first, so that sorting compares one number for most pairs of rows.
    """
    order = [F.col("P").asc_nulls_last()] + [F.col(t).asc_nulls_last() for t in ties if t in df.columns]
    hashed = df.withColumn("_KEY", F.xxhash64(*keys))
    ranked = hashed.withColumn("_RANK", F.row_number().over(Window.partitionBy("_KEY", *keys).orderBy(*order)))
    return ranked.filter(F.col("_RANK") == 1).drop("_RANK", "_KEY")


def finalize(
    df: DataFrame,
    study_id: str | Column | None = None,
    trait: str | Column | None = None,
    population: str | Column | None = None,
    source_file: str | Column | None = None,
    dedupe_keys: Sequence[str] = ("STUDY_ID", "POPULATION", "VARIANT_ID"),
) -> DataFrame:
    """Constants, order-free ids, one strongest row per variant, canonical columns."""
    constants: dict[str, object] = {"REF": None, "ALT": None, "BUILD": "GRCh38"}
    given = {"STUDY_ID": study_id, "TRAIT": trait, "POPULATION": population, "SOURCE_FILE": source_file}
    constants.update({name: value for name, value in given.items() if value is not None})
    constants["VARIANT_ID"] = V.pair_variant_id()
    return keep_strongest(canonical_projection(df, constants), list(dedupe_keys))


def significant(df: DataFrame, p_threshold: float = GENOME_WIDE) -> DataFrame:
    """Associations below the threshold, strongest first."""
    return df.filter(F.col("P") < p_threshold).orderBy("P", "VARIANT_ID")


def in_genome_order(df: DataFrame) -> DataFrame:
    """Sorted by CHR (text, so "10" precedes "2") and POS with a range shuffle."""
    return df.orderBy("CHR", "POS", "VARIANT_ID")


def odds_ratio_signs(rows: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Per key the smallest BETA, the median, and whether the column looks like odds ratios.

    It does when all values are positive and the median lies between 0.5 and 2.
    Values that are no finite numbers say nothing about the scale and are left out.
    The rows are stored once, because the exact median reads them several times.
    """
    keys = list(keys) or ["_ALL"]
    finite = checkpointed(rows.withColumn("_ALL", F.lit(1)).filter(S.is_finite("BETA")).select(*keys, "BETA"))
    low = finite.groupBy(*keys).agg(F.min("BETA").alias("LOWEST"))
    both = low.join(exact_median(finite, keys, "BETA"), keys).drop("_ALL")
    return both.withColumn("LOOKS_LIKE_ODDS", (F.col("LOWEST") > 0) & (F.col("MEDIAN") > 0.5) & (F.col("MEDIAN") < 2))


def refuse_odds_ratio_as_beta(derived: DataFrame) -> None:
    """Stop when the BETA column looks like odds ratios."""
    found = odds_ratio_signs(derived).first()
    if found is not None and found["LOOKS_LIKE_ODDS"]:
        raise OddsRatioAsBetaError(
            f"the column mapped to BETA is strictly positive with median {found['MEDIAN']:.3f}; it looks like an odds ratio"
        )


def qc_summary(
    derived: DataFrame,
    final: DataFrame,
    keys: Sequence[str] = ("POPULATION",),
    p_threshold: float = GENOME_WIDE,
) -> DataFrame:
    """Rows in, kept, removed and significant; inflation; completeness fractions."""
    keys = list(keys)
    rows_in = derived.groupBy(*keys).agg(F.count("*").alias("N_INPUT"))

    def fraction(name: str) -> Column:
        return F.avg(F.col(name).isNotNull().cast("double"))

    kept = final.groupBy(*keys).agg(
        F.count("*").alias("N_AFTER_QC"),
        F.sum((F.col("P") < p_threshold).cast("bigint")).alias("N_SIGNIFICANT"),
        fraction("EAF").alias("FRACTION_WITH_EAF"),
        fraction("N").alias("FRACTION_WITH_N"),
        fraction("RSID").alias("FRACTION_WITH_RSID"),
    )
    chi2 = exact_median(final.withColumn("CHI2", F.col("Z") * F.col("Z")), keys, "CHI2", "MEDIAN_CHI2")
    return (
        rows_in.join(kept, keys, "left")
        .join(chi2, keys, "left")
        .withColumn("N_AFTER_QC", F.coalesce("N_AFTER_QC", F.lit(0)))
        .withColumn("N_SIGNIFICANT", F.coalesce("N_SIGNIFICANT", F.lit(0)))
        .withColumn("N_REMOVED", F.col("N_INPUT") - F.col("N_AFTER_QC"))
        .withColumn("LAMBDA_GC", F.col("MEDIAN_CHI2") / S.MEDIAN_CHI2_1DF)
    )


def build_concordance(
    assoc: DataFrame, bases: DataFrame, keys: Sequence[str] = ()
) -> DataFrame:
    """Share of single-base variants, all of them, whose reference base is one allele.

    ``bases`` is (CHR, POS, BASE); the check is one equi join.
    """
    snvs = assoc.filter((F.length("EA") == 1) & (F.length("NEA") == 1))
    checked = snvs.join(bases.select("CHR", "POS", "BASE"), ["CHR", "POS"])
    hit = (F.col("BASE") == F.col("EA")) | (F.col("BASE") == F.col("NEA"))
    return checked.groupBy(*keys).agg(
        F.count("*").alias("N_CHECKED"), F.avg(hit.cast("double")).alias("REF_CONCORDANCE")
    )


def validate_build(
    assoc: DataFrame, bases: DataFrame, min_concordance: float = 0.9
) -> dict[str, object]:
    """Fail a file whose alleles disagree with the reference sequence."""
    row = build_concordance(assoc, bases).first()
    if not row["N_CHECKED"]:
        return {"status": "skipped", "reason": "no SNVs"}
    if row["REF_CONCORDANCE"] < min_concordance:
        raise BuildMismatchError(
            f"only {row['REF_CONCORDANCE']:.1%} of SNVs match the reference sequence"
        )
    return {"status": "checked", "n_checked": row["N_CHECKED"], "ref_concordance": row["REF_CONCORDANCE"]}
