"""From association text to the canonical table and its record, in one run.

The text is parsed once, by a job that stores the rows that pass the quality control and
observes how many came in and the smallest effect; the next one takes the strongest rows,
writes the table and observes what the record says of it.  Observed are only rows of a
writing stage, which Spark counts once however often executors are lost: a count observed
before a shuffle would grow when a lost map task is run again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from variantloom.functions import statistics as S
from variantloom.operators import harmonize
from variantloom.plans.ordered import exact_median
from variantloom.session import stored
from variantloom.sinks.export import write_parquet, write_qc_report
from variantloom.sources import fasta, text


@dataclass(frozen=True)
class Analysis:
    """What is known of a study before its file is opened."""

    analysis_id: str
    study_accession: str
    trait: str
    population: str
    analysis_label: str
    build: str | None = None
    n_cases: float | None = None
    n_controls: float | None = None
    n_total: float | None = None


@dataclass(frozen=True)
class Reference:
    """Sequences for the build check: numbered lines and their index."""

    lines: DataFrame
    index: DataFrame


# Fields of the record, in the order they are written.
RECORD = T.StructType(
    [
        T.StructField("analysis_id", T.StringType()),
        T.StructField("study_accession", T.StringType()),
        T.StructField("population", T.StringType()),
        T.StructField("engine", T.StringType()),
        T.StructField("source_file", T.StringType()),
        T.StructField("column_mapping", T.MapType(T.StringType(), T.StringType())),
        T.StructField("derived", T.MapType(T.StringType(), T.BooleanType())),
        T.StructField("n_input", T.LongType()),
        T.StructField("n_after_qc", T.LongType()),
        T.StructField("n_removed", T.LongType()),
        T.StructField("n_significant", T.LongType()),
        T.StructField("lambda_gc", T.DoubleType()),
        T.StructField("fraction_with_eaf", T.DoubleType()),
        T.StructField("fraction_with_n", T.DoubleType()),
        T.StructField("fraction_with_rsid", T.DoubleType()),
        T.StructField("n_cases", T.DoubleType()),
        T.StructField("n_controls", T.DoubleType()),
        T.StructField("n_total", T.DoubleType()),
        T.StructField("build", T.StringType()),
        T.StructField("build_validation", T.MapType(T.StringType(), T.StringType())),
    ]
)


def harmonise_file(
    spark: SparkSession,
    path: str,
    out: str,
    analysis: Analysis,
    form: str | None = None,
    reference: Reference | None = None,
    bases: DataFrame | None = None,
    p_threshold: float = harmonize.GENOME_WIDE,
    min_info: float | None = None,
    min_concordance: float = 0.9,
) -> DataFrame:
    """Write ``out``/sumstats (by chromosome), ``out``/significant and ``out``/record; return the record, one row.

    The build is checked against the sequences of ``reference``, or against ``bases``
    (CHR, POS, BASE) where these are at hand.  A label that is not the study's population, another build, effects that are odds
    ratios and alleles that disagree with the reference are errors; a refused file has
    no record, which is what later steps look for.
    """
    harmonize.check_label(analysis.population, analysis.analysis_label)
    if analysis.build not in (None, "GRCh38"):
        raise harmonize.BuildMismatchError(f"{path} is on {analysis.build}; positions are not lifted over here")
    raw, heads = text.read_association_files(spark, path, form)
    mapping = heads.orderBy("FILE").first()["MAPPING"]
    derived = harmonize.derive_statistics(raw, analysis.n_cases, analysis.n_controls, analysis.n_total)
    came = Observation("came")
    told = derived.observe(came, F.count(F.lit(1)).alias("n"), F.min(F.when(S.is_finite("BETA"), F.col("BETA"))).alias("low"))
    kept = stored(harmonize.apply_qc(told, min_info=min_info))
    n_input, low = came.get["n"] or 0, came.get["low"]
    if "BETA" in mapping and (low or 0) > 0:
        harmonize.refuse_odds_ratio_as_beta(derived)  # the median is asked for only where no effect is negative

    final = harmonize.finalize(
        kept, analysis.study_accession, analysis.trait, analysis.analysis_label, path
    )
    seen = Observation("written")
    share = lambda name: F.avg(F.col(name).isNotNull().cast("double"))
    watched = final.observe(
        seen, F.count(F.lit(1)).alias("n"), F.sum((F.col("P") < p_threshold).cast("bigint")).alias("significant"),
        share("EAF").alias("eaf"), share("N").alias("sized"), share("RSID").alias("rsid"),
    )
    write_parquet(watched, f"{out}/sumstats", ("CHR",))
    counts = seen.get
    table = spark.read.schema(final.schema).parquet(f"{out}/sumstats").select(*final.columns)
    write_parquet(harmonize.significant(table, p_threshold), f"{out}/significant")

    chi2 = exact_median(table.select((F.col("Z") * F.col("Z")).alias("CHI2")), [], "CHI2").first()
    check = {"status": "skipped", "reason": "no reference sequence"}
    if reference is not None:
        bases = fasta.bases(table.filter((F.length("EA") == 1) & (F.length("NEA") == 1)), reference.lines, reference.index)
    if bases is not None:
        check = harmonize.validate_build(table, bases, min_concordance)
    have = set(mapping)
    facts = {
        "beta_from_or": "BETA" not in have and "OR" in have,
        "se_from_ci": "SE" not in have and "OR_L95" in have,
        "n_from_metadata": "N" not in have and analysis.n_total is not None,
    }
    n = counts["n"] or 0
    row = (
        analysis.analysis_id, analysis.study_accession, analysis.analysis_label, "spark", path, mapping, facts, n_input, n, n_input - n,
        counts["significant"] or 0, chi2["MEDIAN"] / S.MEDIAN_CHI2_1DF if chi2 and chi2["MEDIAN"] else None, counts["eaf"], counts["sized"], counts["rsid"],
        analysis.n_cases, analysis.n_controls, analysis.n_total, "GRCh38", {k: str(v) for k, v in check.items()},
    )
    record = spark.createDataFrame([row], RECORD).coalesce(1)
    write_qc_report(record, f"{out}/record")
    return record
