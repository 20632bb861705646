"""Annotation, screen, evidence, study selection and the whole run."""

import pytest
from pyspark.sql import functions as F

from variantloom.operators import ancestry, annotation, evidence, phenotype, qtl, screen, selection
from variantloom.plans import stages
from variantloom.queries import registry, views

SMOKE = "/root/testdata/sf0.001"


def test_categories(spark):
    rows = spark.createDataFrame(
        [("intron_variant&splice_region_variant", "SPLICING"), ("missense_variant", "CODING"), ("3_prime_UTR_variant", "UTR"), ("intron_variant", "INTRONIC"), ("strange", "OTHER"), (None, "OTHER")],
        "c string, want string",
    )
    assert all(r["got"] == r["want"] for r in rows.select("want", annotation.functional_category("c").alias("got")).collect())
    with pytest.raises(ValueError):
        annotation.lncrna_context(rows)


def test_prioritised_keeps_top_and_sets(spark):
    rows = spark.createDataFrame(
        [("a", "L", "EUR", 0.5, []), ("b", "L", "EUR", 0.001, ["L:CS1"]), ("c", "L", "EUR", 0.001, []), ("d", "M", "EUR", 0.002, [])],
        "VARIANT_ID string, LOCUS_ID string, POPULATION string, PIP double, CREDIBLE_SETS array<string>",
    )
    cross = spark.createDataFrame([("c", 0.2), ("a", 0.9)], "VARIANT_ID string, CROSS_ANCESTRY_PIP double")
    out = annotation.select_prioritised_variants([rows], cross).collect()
    assert sorted(r["VARIANT_ID"] for r in out) == ["a", "b", "c", "d"]
    assert {r["VARIANT_ID"]: r["PIP"] for r in out}["a"] == 0.5


def test_tissues(spark):
    offered = spark.createDataFrame([("b", 1), ("a", 2), ("a", 3)], "TISSUE string, n int")
    assert qtl.choose_tissues(offered).count() == 3
    assert sorted(r["n"] for r in qtl.choose_tissues(offered, ["a"]).collect()) == [2, 3]
    with pytest.raises(ValueError, match="y, z"):
        qtl.choose_tissues(offered, ["z", "a", "y"])
    table = qtl.normalise_qtl(spark.createDataFrame([("chr1_5_A_G_b38", "g")], "variant string, gene_id string"), "Liver", "eQTL")
    row = table.first()
    assert (row["GENE"], row["QTL_PHENOTYPE"], row["QTL_PIP"]) == ("g", "g", None)
    with pytest.raises(ValueError):
        qtl.normalise_qtl(spark.createDataFrame([("x",)], "gene_id string"), "Liver", "eQTL")


def test_screen(spark):
    fm = spark.createDataFrame([("a", "L", "EUR", 0.5), ("b", "L", "EUR", 0.2)], "VARIANT_ID string, LOCUS_ID string, POPULATION string, PIP double")
    table = spark.createDataFrame(
        [("a", "T", "eQTL", "G", 0.4), ("b", "T", "eQTL", "G", 0.5), ("b", "T", "eQTL", "G", None)], "VARIANT_ID string, TISSUE string, QTL_TYPE string, GENE string, QTL_PIP double"
    )
    row = screen.pair_screen(screen.variant_screen(fm, table)).first()
    assert row["LCLPP"] == pytest.approx(0.28) and row["MAX_vCLPP"] == pytest.approx(0.2)
    assert (row["N_MATCHING_VARIANTS"], row["N_NULL_PIP"], row["TOP_VARIANT"]) == (3, 1, "a")


def test_evidence_join_keys_and_score(spark):
    fm = spark.createDataFrame([("a", "L", "EUR", 0.5)], "VARIANT_ID string, LOCUS_ID string, POPULATION string, PIP double")
    best = spark.createDataFrame([("a", "missense_variant", "CODING", "G")], "VARIANT_ID string, CONSEQUENCE string, FUNCTIONAL_CATEGORY string, GENE string")
    table = spark.createDataFrame([("a", "T", "eQTL", "G", 0.4), ("a", "T", "eQTL", "H", 0.9)], "VARIANT_ID string, TISSUE string, QTL_TYPE string, GENE string, QTL_PIP double")
    overlap = screen.variant_screen(fm, table)
    out = evidence.integrate_evidence(fm, "t", annotation=best, qtl=table, coloc=overlap, pairs=screen.pair_screen(overlap))
    assert "QTL_PIP_EVIDENCE" in out.columns
    row = evidence.add_priority_components(out).collect()
    assert len(row) == 1 and row[0]["GENE"] == "G"
    assert row[0]["PRIORITY_SCORE"] == pytest.approx(3 * 0.5 + 2 * 0.2 + 1)
    wide = evidence.cross_population_comparison(fm.unionByName(fm.withColumn("POPULATION", F.lit("AFR")).withColumn("PIP", F.lit(0.05)))).first()
    assert (wide["EUR_PIP"], wide["AFR_PIP"], wide["N_SUPPORTING_POPULATIONS"], wide["EAS_PIP"]) == (0.5, 0.05, 1, None)
    assert wide["MEAN_POPULATION_PIP"] == pytest.approx(0.275)


@pytest.mark.parametrize(
    "raw, want",
    [
        ("513266 European (U.S.)", [("European", 513266, "U.S.")]),
        ("1,200 European, East Asian", [("European", 1200, None), ("East Asian", None, None)]),
        ("Greater Middle Eastern (Middle Eastern, North African or Persian) (Iran)", [("Greater Middle Eastern (Middle Eastern, North African or Persian)", None, "Iran")]),
        ("Martian (Base 1), NR", [("Martian", None, "Base 1"), ("NR", None, None)]),
        ("European (open", [("European", None, "open")]),
        ("", [("NR", None, None)]),
        (None, [("NR", None, None)]),
    ],
)
def test_ancestry_text(spark, raw, want):
    df = spark.createDataFrame([("s", raw)], "study_accession string, t string")
    rows = ancestry.parse_ancestry_text(df, "t", ["study_accession"]).orderBy("RECORD").collect()
    assert [(r["CATEGORY"], r["N"], r["COUNTRY"]) for r in rows] == want


def test_study_population_and_sizes(spark):
    rows = spark.createDataFrame(
        [("A", "initial", 0, "European", 100, None), ("B", "initial", 0, "European", 100, None), ("B", "initial", 1, "East Asian", 100, "Japan"),
         ("C", "replication", 0, "Hispanic or Latin American", 5, None), ("D", "initial", 0, "NR", None, None), ("E", "initial", 0, "Oceanian", None, None),
         ("A", "replication", 1, "East Asian", 7, None)],
        "study_accession string, STAGE string, RECORD int, CATEGORY string, N bigint, COUNTRY string",
    )
    got = {r["study_accession"]: r for r in ancestry.study_populations(rows).collect()}
    assert {k: v["population"] for k, v in got.items()} == {"A": "EUR", "B": "MULTI", "C": "AMR", "D": "UNKNOWN", "E": "UNMAPPED"}
    assert got["B"]["analysis_label"] == "COMBINED_PUBLISHED" and got["B"]["reported_ancestry"] == "European; East Asian (Japan)"
    assert got["C"]["population_approximate"] and got["A"]["n_structured"] == 100 and got["D"]["analysis_label"] is None
    texts = spark.createDataFrame([("1,000 European ancestry cases, 2,000 controls, 50 individuals",), ("300 women",), ("none",), (None,)], "initial_sample_size string")
    sized = [(r["n_cases"], r["n_controls"], r["n_total"], r["trait_type"]) for r in ancestry.apply_sample_size(texts).collect()]
    assert sized == [(1000, 2000, 3050, "binary"), (None, None, 300, "quantitative_or_unspecified"), (None, None, None, None), (None, None, None, None)]


TERMS = [("EFO_1", "migraine", ["migraine disorder"]), ("EFO_2", "headache", [])]


def test_resolution_and_matching(spark):
    terms = spark.createDataFrame(TERMS, "term_id string, label string, synonyms array<string>")
    found, rejected = phenotype.resolve_phenotype(terms, "Migraine")
    assert (found.resolution_type, found.term_ids, found.synonyms) == ("exact_label", ["EFO_1"], ["migraine", "migraine disorder"])
    assert [r["term_id"] for r in rejected.collect()] == ["EFO_2"]
    assert phenotype.resolve_phenotype(terms, "migraine disorder")[0].resolution_type == "exact_synonym"
    assert phenotype.resolve_phenotype(terms, "x", pinned_ids=["EFO:9"])[0].term_ids == ["EFO_9"]
    assert phenotype.resolve_phenotype(terms, "asthma")[0].resolution_type == "free_text"
    assert phenotype.resolve_phenotype(terms, "migraines", fuzzy=True)[0].term_ids == ["EFO_1"]
    studies = spark.createDataFrame(
        [("S1", "Migraine", ["EFO_1"], ["migraine"]), ("S2", "Headache", ["EFO_2"], ["headache"]), ("S3", "Migraine (women)", [], []),
         ("S4", "x", [], ["Migraine disorder"]), ("S5", "migraines", [], []), ("S6", None, None, None)],
        "study_accession string, reported_trait string, mapped_trait_ids array<string>, mapped_trait_labels array<string>",
    )
    got = {r["study_accession"]: r for r in phenotype.match_studies(studies, found).collect()}
    assert {k: v["match_type"] for k, v in got.items()} == {
        "S1": "exact_mapped_trait", "S2": "none", "S3": "exact_reported_trait", "S4": "synonym_mapped_trait", "S5": "fuzzy_reported_trait", "S6": "none",
    }
    assert got["S1"]["match_score"] == 1.0 and got["S5"]["match_reason"] == "reported trait is 0.94 alike"


def test_fuzzy_ratio_equals_difflib(spark):
    import difflib

    parts = views.table(spark, SMOKE, "part").select(F.col("p_partkey").cast("string").alias("term_id"), F.col("p_name").alias("label"), F.array("p_type").alias("synonyms"))
    rows = {r["term_id"]: round(r["RATIO"], 6) for r in phenotype.fuzzy_candidates(parts, "small rings", 0.5).collect()}
    want = {}
    for part in views.table(spark, SMOKE, "part").collect():
        for text in (part["p_name"].lower(), part["p_type"].lower()):
            ratio = difflib.SequenceMatcher(None, "small rings", text).ratio()
            key = str(part["p_partkey"])
            want[key] = max(want.get(key, 0), round(ratio, 6))
    assert rows == {k: v for k, v in want.items() if v >= 0.5}


def test_selection_prefers_larger_study(spark):
    files = spark.createDataFrame(
        [(s, 0, f"file:///{s}.tsv", "harmonised", True, "GRCh38", None, "header_parsed", True, False, True, None, None, True, 10) for s in ("A", "B")],
        "study_accession string, ORD bigint, url string, kind string, is_harmonised boolean, build string, file_type string, probe_status string, has_beta boolean, has_or boolean, has_se boolean, has_eaf boolean, has_n boolean, has_alleles boolean, probe_bytes bigint",
    )
    base = spark.createDataFrame([("A", 1000), ("B", 10000)], "study_accession string, n_total bigint")
    empty = F.array().cast("array<string>")
    studies = base.select(
        "*", F.lit("trait").alias("reported_trait"), empty.alias("mapped_trait_labels"), empty.alias("mapped_trait_ids"), empty.alias("background_trait_labels"), empty.alias("cohorts"),
        *[F.lit("EUR").alias(c) for c in ("population", "analysis_label")], *[F.lit(None).cast("string").alias(c) for c in (
            "reported_ancestry", "population_reason", "n_source", "trait_type", "initial_sample_size", "pubmed_id", "first_author", "publication_date", "summary_stats_url")],
        F.lit(False).alias("population_approximate"), F.lit(None).cast("bigint").alias("n_cases"), F.lit(None).cast("bigint").alias("n_controls"), F.lit(False).alias("gxe"),
        F.lit(True).alias("summary_stats_available"), F.lit("exact_mapped_trait").alias("match_type"), F.lit(1.0).alias("match_score"), F.lit("m").alias("match_reason"),
    )
    scored = selection.score_candidates(selection.build_candidate_table(studies, files))
    chosen = selection.select_studies(scored)
    rows = {r["study_accession"]: r for r in chosen.collect()}
    assert rows["B"]["selected"] and not rows["A"]["selected"]
    assert rows["B"]["analysis_id"] == "EUR" and rows["A"]["selection_reason"].startswith("behind a better one; rank 2 of label EUR, score ")
    assert rows["B"]["selection_reason"].startswith("primary; rank 1 of label EUR, score ")
    assert len(selection.selection_export(chosen).columns) == 33 and len(selection.selected_analyses(chosen).columns) == 17
    everything = {r["study_accession"]: r["analysis_id"] for r in selection.select_studies(scored, all_studies=True).collect()}
    assert everything == {"B": "EUR", "A": "EUR__A"}
    assert selection.score_candidates(selection.build_candidate_table(studies)).filter("usable").count() == 2


def test_entry_contract():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) >= 70


def test_whole_run(spark, tmp_path):
    assoc = registry._harmonised(spark, SMOKE)
    done = stages.run(
        spark, str(tmp_path), assoc, views.panel(spark, SMOKE).select("CHR", "POS", "ID", "REF", "ALT"), views.dosage(spark, SMOKE), views.qtl(spark, SMOKE),
        views.consequence(spark, SMOKE), registry._spliceai(spark, SMOKE), registry._pangolin(spark, SMOKE), "trait",
        spark.createDataFrame([("S", True)], "study_accession string, selected boolean"), min_variants=3, max_effects=2, r2=0.3, window_bp=10_000, max_missing=None,
    )
    assert done["evidence"].count() > 0 and done["report_summary"].first()["evidence_rows"] == done["evidence"].count()
    pips = done["variants"].agg(F.min("PIP"), F.max("PIP")).first()
    assert 0 <= pips[0] <= pips[1] <= 1
    low = done["pairs"].filter(F.col("LCLPP") < F.col("MAX_vCLPP") - 1e-9).count()
    assert low == 0
    overlapping = done["loci"].alias("a").join(done["loci"].alias("b"), F.expr(
        "a.POPULATION = b.POPULATION and a.CHR = b.CHR and a.LOCUS_ID < b.LOCUS_ID and a.START <= b.END and b.START <= a.END"))
    assert overlapping.count() == 0
