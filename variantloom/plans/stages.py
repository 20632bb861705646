"""A whole analysis as stored stages.

Every stage is written as Parquet under one folder and read back, so lineage is
cut, a lost executor only repeats the running stage, and an interrupted run
continues after the last finished stage.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from variantloom.operators import (
    annotation,
    evidence,
    finemap,
    harmonize,
    ld,
    loci,
    meta,
    qtl,
    region,
    report,
    screen,
    splicing,
)
from variantloom.schema import SUPERPOPULATIONS
from variantloom.sinks.export import write_parquet, write_tsv
from variantloom.sources.tables import union_tables


class Stages:
    """Tables of a run by name; ``store`` writes once and reads back."""

    def __init__(self, spark: SparkSession, folder: str, resume: bool = False):
        self.spark, self.folder, self.resume = spark, folder.rstrip("/"), resume

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def store(self, name: str, build: Callable[[], DataFrame], partition_by: tuple[str, ...] = ()) -> DataFrame:
        if self.resume:
            try:
                return self.spark.read.parquet(self.path(name))
            except AnalysisException:
                pass
        df = build()
        write_parquet(df, self.path(name), partition_by)
        # Partition values are read back with the written types, not inferred ones.
        return self.spark.read.schema(df.schema).parquet(self.path(name)).select(*df.columns)


def associate(stages: Stages, assoc: DataFrame, populations: Sequence[str], trait: str, p_threshold: float) -> dict[str, DataFrame]:
    """Canonical table, its significant part, and the meta-analysis when two populations allow it."""
    table = stages.store("sumstats", lambda: assoc, ("POPULATION", "CHR"))
    out = {"sumstats": table, "significant": stages.store("significant", lambda: harmonize.significant(table, p_threshold))}
    if len(populations) >= 2:
        out["meta"] = stages.store("meta", lambda: harmonize.in_genome_order(meta.run_meta(table, populations, trait)))
    return out


def locate(
    stages: Stages, matched: DataFrame, units: DataFrame, meta_table: DataFrame | None, p_threshold: float, r2: float, kb: int, window_bp: int
) -> dict[str, DataFrame]:
    """Clumps and loci per population, meta-analysis hits, and their union."""
    variants = matched.select("POPULATION", "CHR", "POS", "P", "VARIANT_ID")
    edges = stages.store(
        "edges", lambda: ld.ld_edges(units, variants.filter(F.col("P") <= p_threshold), min_r2=r2, window_bp=kb * 1000)
    )
    members = stages.store("clump_members", lambda: loci.clump_members(variants, edges, p1=p_threshold, r2=r2, kb=kb))
    leads = loci.clumps(members)
    table = stages.store("loci", lambda: loci.construct_loci(leads, window_bp=window_bp))
    frames = [table]
    if meta_table is not None:
        hits = loci.hits_as_leads(meta_table.filter(F.col("P") < p_threshold))
        frames.append(loci.construct_loci(hits, window_bp=window_bp))
    return {"loci": table, "combined_loci": stages.store("combined_loci", lambda: loci.union_loci(union_tables(frames)))}


def fine_map(
    stages: Stages, matched: DataFrame, units: DataFrame, places: DataFrame, min_variants: int, max_effects: int
) -> dict[str, DataFrame]:
    """All loci at once; loci that fail a gate go to the failures table with their reason.

    Variants without an LD vector cannot be fine-mapped; ``ld_coverage`` and the summary count them per locus.
    """
    with_ld = matched.join(units.select("POPULATION", "VARIANT_ID"), ["POPULATION", "VARIANT_ID"], "left_semi")
    rows = stages.store("regional", lambda: region.rows_in_loci(with_ld.withColumn("Z", F.col("Z_ALT")), places))
    gates = region.locus_gates(rows, min_variants=min_variants, loci=places)
    passed, failures = region.split_by_gate(rows, gates)
    placed = region.rows_in_loci(matched, places)
    covered = stages.store("ld_coverage", lambda: finemap.ld_coverage(placed, units))
    results = finemap.finemap_from_units(
        passed.select("LOCUS_ID", "POPULATION", "VARIANT_ID", "CHR", "POS", "REF", "ALT", "Z"), units, max_effects=max_effects
    )
    results["summary"] = results["summary"].join(covered, finemap.LOCUS, "left")
    out = {name: stages.store(f"finemap_{name}", lambda df=df: df) for name, df in results.items()}
    out["ld_coverage"] = covered
    out["failures"] = stages.store("failed_loci", lambda: failures)
    out["sample_size"] = stages.store("locus_sample_size", lambda: region.locus_sample_size(rows))
    return out


def run(
    spark: SparkSession,
    folder: str,
    assoc: DataFrame,
    panel: DataFrame,
    dosages: DataFrame,
    qtl_table: DataFrame,
    consequences: DataFrame,
    spliceai: DataFrame,
    pangolin: DataFrame,
    trait: str,
    selection: DataFrame,
    populations: Sequence[str] = SUPERPOPULATIONS,
    p_threshold: float = harmonize.GENOME_WIDE,
    r2: float = 0.1,
    kb: int = 1000,
    window_bp: int = 1_000_000,
    min_variants: int = 10,
    max_effects: int = 10,
    maf: float | None = 0.01,
    max_missing: float | None = 0.05,
    resume: bool = False,
) -> dict[str, DataFrame]:
    """From a harmonised table to the report; returns every stage table."""
    stages = Stages(spark, folder, resume)
    done = associate(stages, assoc, populations, trait, p_threshold)
    matched = stages.store("matched", lambda: region.match_to_reference(done["sumstats"], panel, ["POPULATION"]))
    units = stages.store("units", lambda: ld.standardise(dosages, maf, max_missing))
    done |= locate(stages, matched, units, done.get("meta"), p_threshold, r2, kb, window_bp)
    mapped = fine_map(stages, matched, units, done["loci"], min_variants, max_effects)
    done |= mapped
    variants = mapped["variants"]
    cross = stages.store("cross_population_pip", lambda: finemap.consensus_pip(variants))
    chosen = stages.store("prioritised", lambda: annotation.select_prioritised_variants([variants], cross))
    best = stages.store("best_consequence", lambda: annotation.best_consequence(consequences))
    done["variant_summary"] = stages.store("variant_summary", lambda: annotation.annotate(chosen, best))
    matches = stages.store("qtl_matches", lambda: qtl.match_prioritised(qtl_table, chosen), ("QTL_TYPE",))
    done["gene_tissue_summary"] = stages.store("gene_tissue_summary", lambda: qtl.gene_tissue_summary(matches))
    ai = splicing.summarise(spliceai, "SPLICEAI_MAX", "SPLICEAI_GENES")
    done["unscored"] = stages.store("unscored", lambda: splicing.unscored(chosen.select("VARIANT_ID"), ai))
    both = stages.store(
        "integrated_splicing", lambda: splicing.integrate_splicing(ai, splicing.summarise(pangolin, "PANGOLIN_SCORE", "PANGOLIN_GENES"))
    )
    overlap = stages.store("variant_screen", lambda: screen.variant_screen(variants, matches, cross))
    pairs = stages.store("pair_screen", lambda: screen.pair_screen(overlap))
    done["gene_summary"] = stages.store("gene_summary", lambda: screen.gene_summary(pairs))
    done["top_candidates"] = stages.store("top_candidates", lambda: screen.top_candidates(pairs))
    comparison = stages.store("cross_population", lambda: evidence.cross_population_comparison(variants))
    done["evidence"] = stages.store(
        "evidence",
        lambda: evidence.add_priority_components(
            evidence.integrate_evidence(
                variants, trait, annotation=best, qtl=matches, coloc=overlap, splicing=both, cross_ancestry=cross, pairs=pairs
            ).join(comparison, "VARIANT_ID", "left")
        ),
    )
    write_tsv(done["evidence"], stages.path("evidence_tsv"))
    tables = report.report_tables(selection, comparison, done["evidence"], matches, mapped["failures"], trait)
    for name, df in tables.items():
        write_tsv(df, stages.path(f"report/{name}"))
    return {**done, "comparison": comparison, "pairs": pairs, **{f"report_{k}": v for k, v in tables.items()}}
