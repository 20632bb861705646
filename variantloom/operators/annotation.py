"""Prioritised variants and consequence annotation."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from variantloom.session import checkpointed

# Functional classes in order of precedence with their terms.
CONSEQUENCE_CLASSES: dict[str, tuple[str, ...]] = {
    "SPLICING": ("splice_acceptor_variant", "splice_donor_variant", "splice_region_variant"),
    "CODING": (
        "stop_gained", "stop_lost", "start_lost", "frameshift_variant", "missense_variant", "inframe_insertion",
        "inframe_deletion", "synonymous_variant", "coding_sequence_variant",
    ),
    "UTR": ("5_prime_UTR_variant", "3_prime_UTR_variant"),
    "REGULATORY": ("regulatory_region_variant", "TF_binding_site_variant", "mature_miRNA_variant"),
    "NONCODING_RNA": (
        "non_coding_transcript_exon_variant", "non_coding_transcript_variant", "NMD_transcript_variant",
    ),
    "INTRONIC": ("intron_variant",),
    "UPSTREAM": ("upstream_gene_variant",),
    "DOWNSTREAM": ("downstream_gene_variant",),
    "INTERGENIC": ("intergenic_variant",),
}
CLASS_ORDER = (*CONSEQUENCE_CLASSES, "OTHER")


def functional_category(consequence: Column | str) -> Column:
    """First class, by precedence, that any of the ``&``-separated terms belongs to."""
    column = F.col(consequence) if isinstance(consequence, str) else consequence
    terms = F.split(F.coalesce(column, F.lit("")), "&")
    chain = None
    for name, members in CONSEQUENCE_CLASSES.items():
        hit = F.arrays_overlap(terms, F.array(*[F.lit(m) for m in members]))
        chain = F.when(hit, name) if chain is None else chain.when(hit, name)
    return chain.otherwise("OTHER")


def category_rank(category: Column | str) -> Column:
    """0 for the most severe class up to 9 for OTHER."""
    column = F.col(category) if isinstance(category, str) else category
    return (F.array_position(F.array(*[F.lit(c) for c in CLASS_ORDER]), column) - 1).cast("int")


def best_consequence(consequences: DataFrame) -> DataFrame:
    """One consequence per variant: lowest class rank, then the consequence text, then gene."""
    ties = [c for c in ("CONSEQUENCE", "GENE", "GENE_ID") if c in consequences.columns]
    order = [category_rank("FUNCTIONAL_CATEGORY").asc(), *[F.col(c).asc_nulls_last() for c in ties]]
    ranked = consequences.withColumn("_R", F.row_number().over(Window.partitionBy("VARIANT_ID").orderBy(*order)))
    return ranked.filter(F.col("_R") == 1).drop("_R")


def prioritised_rows(finemapped: DataFrame, min_pip: float = 0.01, pip: str = "PIP", keep_top: bool = True) -> DataFrame:
    """Rows with enough PIP, in a credible set, or with the top PIP of their locus.

    The locus maximum is an aggregate joined back, so a very large locus is not
    sorted in one task.
    """
    keep = F.col(pip) >= min_pip
    if "CREDIBLE_SETS" in finemapped.columns:
        keep = keep | (F.size("CREDIBLE_SETS") > 0)
    if not keep_top:
        return finemapped.filter(keep)
    keys = ["POPULATION", "LOCUS_ID"]
    top = checkpointed(finemapped.groupBy(*keys).agg(F.max(pip).alias("_TOP")))
    return finemapped.join(top, keys).filter(keep | (F.col(pip) == F.col("_TOP"))).drop("_TOP")


def select_prioritised_variants(
    population_results: Sequence[DataFrame], cross_ancestry: DataFrame | None = None, min_pip: float = 0.01
) -> DataFrame:
    """Distinct union over populations, then the cross-population result; first source kept."""
    parts = [prioritised_rows(frame, min_pip) for frame in population_results]
    if cross_ancestry is not None:
        parts.append(prioritised_rows(cross_ancestry, min_pip, "CROSS_ANCESTRY_PIP", keep_top=False))
    numbered = [part.withColumn("_SOURCE", F.lit(i)) for i, part in enumerate(parts)]
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), numbered)
    ties = [F.col(c).desc_nulls_last() for c in ("PIP", "CROSS_ANCESTRY_PIP") if c in union.columns]
    ties += [F.col(c).asc_nulls_last() for c in ("POPULATION", "LOCUS_ID") if c in union.columns]
    first = Window.partitionBy("VARIANT_ID").orderBy("_SOURCE", *ties)
    return union.withColumn("_R", F.row_number().over(first)).filter(F.col("_R") == 1).drop("_R", "_SOURCE")


def annotate(prioritised: DataFrame, best: DataFrame) -> DataFrame:
    """Best consequence onto prioritised variants."""
    clash = (set(prioritised.columns) & set(best.columns)) - {"VARIANT_ID"}
    renamed = best.withColumnsRenamed({c: f"{c}_right" for c in clash})
    return prioritised.join(renamed, "VARIANT_ID", "left")


def lncrna_context(overlaps: DataFrame) -> DataFrame:
    """Separate statements about coding sequence and non-coding gene bodies."""
    needed = {"VARIANT_ID", "OVERLAPS_PROTEIN_CODING_CDS", "OVERLAPS_LNCRNA_GENE_BODY"}
    missing = needed - set(overlaps.columns)
    if missing:
        raise ValueError(f"overlap table lacks {sorted(missing)}")
    return overlaps.withColumns(
        {
            "OUTSIDE_PROTEIN_CODING_CDS": ~F.col("OVERLAPS_PROTEIN_CODING_CDS"),
            "WITHIN_LNCRNA_GENE_BODY": F.col("OVERLAPS_LNCRNA_GENE_BODY"),
        }
    )
