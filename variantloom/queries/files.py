"""Registered queries of readers and sinks: tables written as files, read back by the readers."""

from __future__ import annotations

import itertools
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from variantloom.operators import harmonize, ld_blocks, ld_spectrum
from variantloom.plans import harmonise
from variantloom.queries import views
from variantloom.queries.registry import query
from variantloom.queries.sql import r6, with_
from variantloom.session import checkpointed, ensure_checkpoint_dir
from variantloom.sinks import export
from variantloom.sources import catalog, fasta, panel, tables, text
from variantloom.sources.blocks import write_bgzf

FILES = 8  # written for each stand-in folder, at the least
ROWS_PER_FILE = 500_000  # so files grow in number, not in size


def folder(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def with_header(rows: DataFrame, header: str) -> DataFrame:
    """(value): lines of ``rows`` over several partitions, each of which starts with the header's lines."""
    lead = header.split("\n")

    def headed(batches):
        for column in itertools.chain([pa.array(lead, pa.string())], (batch.column(0) for batch in batches)):
            yield pa.RecordBatch.from_arrays([column], ["value"])

    n_files = max(FILES, -(-rows.count() // ROWS_PER_FILE))
    return rows.repartition(n_files, F.xxhash64("value")).mapInArrow(headed, "value string")


def joined(sep: str, *columns: str) -> Column:
    """One line of fields; an absent value is an empty field."""
    return F.concat_ws(sep, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]).alias("value")


_READ = "RSID, CHR, POS, EA, NEA, {beta} AS BETA, {se} AS SE, {eaf} AS EAF, N_CASES"


@query("bgzf_scan", with_("assoc") + "SELECT " + _READ.format(beta=r6("BETA"), se=r6("SE"), eaf=r6("EAF")) + " FROM assoc")
def bgzf_scan(spark, sf_dir):
    """Associations written as block-gzip files and read back by byte ranges."""
    rows = views.assoc(spark, sf_dir).select(joined("\t", "RSID", "CHR", "POS", "EA", "NEA", "BETA", "SE", "EAF", "N_CASES"))
    path = folder(spark, "bgzf")
    write_bgzf(with_header(rows, "## written for a test\nrsid\tchromosome\tbase_pair_location\teffect_allele\tother_allele\tbeta\tstandard_error\teffect_allele_frequency\tn_cases"), path)
    return harmonised_numbers(text.read_associations(spark, path, form="bgzf")[0])


def harmonised_numbers(raw: DataFrame) -> DataFrame:
    number = lambda c: F.col(c).try_cast("double").alias(c)
    return raw.select("RSID", "CHR", F.col("POS").cast("bigint").alias("POS"), "EA", "NEA", number("BETA"), number("SE"), number("EAF"), number("N_CASES"))


@query(
    "mixed_layouts",
    """SELECT 'rs' || l_partkey AS RSID, CAST(l_partkey % 22 + 1 AS VARCHAR) AS CHR, CAST(l_orderkey AS BIGINT) AS POS, 'A' AS EA, CASE WHEN l_linenumber % 3 = 2 THEN 'G' ELSE 'C' END AS NEA,
      CASE WHEN l_linenumber % 3 <> 2 THEN CAST(l_quantity AS DOUBLE) END AS BETA, CASE WHEN l_linenumber % 3 <> 1 THEN CAST(l_tax AS DOUBLE) END AS SE,
      CASE WHEN l_linenumber % 3 = 1 THEN CAST(l_discount AS DOUBLE) END AS EAF, CASE WHEN l_linenumber % 3 = 2 THEN CAST(l_suppkey AS DOUBLE) END AS N_CASES FROM lineitem""",
)
def mixed_layouts(spark, sf_dir):
    """Files of three layouts in one folder: other columns, other names, other separators, other order."""
    li = views.table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("rs"), "l_partkey").alias("ID"), (F.col("l_partkey") % 22 + 1).alias("C"), F.col("l_orderkey").alias("P"), F.lit("A").alias("A"), F.lit("C").alias("B"), F.lit("G").alias("G"),
        F.col("l_quantity").alias("Q"), F.col("l_tax").alias("T"), F.col("l_discount").alias("D"), F.col("l_suppkey").alias("K"), (F.col("l_linenumber") % 3).alias("L"),
    )
    path = folder(spark, "layouts")
    layouts = {
        0: ("\t", ("C", "P", "ID", "A", "B", "Q", "T"), "##source\n## two comment lines\nchromosome\tbase_pair_location\tvariant_id\teffect_allele\tother_allele\tbeta\tstandard_error"),
        1: (",", ("ID", "D", "B", "A", "P", "C", "Q"), '"SNP","FREQ","A2","A1","BP","CHR","Effect"'),
        2: ("  ", ("P", "C", "ID", "T", "G", "A", "K"), "POS CHROM  MarkerName StdErr  NEA EA Ncase"),
    }
    for number, (sep, columns, header) in layouts.items():
        with_header(li.filter(F.col("L") == number).select(joined(sep, *columns)), header).write.mode("append").text(path)
    return harmonised_numbers(text.read_associations(spark, path)[0])


@query(
    "qc_record",
    with_("kept", "panel").rstrip() + f""", final AS (SELECT * FROM kept QUALIFY row_number() OVER (PARTITION BY VARIANT_ID ORDER BY P NULLS LAST, EA NULLS LAST, NEA NULLS LAST,
        BETA NULLS LAST, SE NULLS LAST, EAF NULLS LAST, N NULLS LAST, N_CASES NULLS LAST, N_CONTROLS NULLS LAST) = 1),
      checked AS (SELECT count(*) AS n, avg(CASE WHEN BASE = EA OR BASE = NEA THEN 1.0 ELSE 0.0 END) AS share
        FROM final JOIN (SELECT CHR, POS, CASE WHEN p_type = 'ECONOMY' THEN 'A' ELSE REF END AS BASE FROM panel) AS b USING (CHR, POS))
    SELECT 'whole_EUR' AS analysis_id, 'whole' AS study_accession, 'EUR' AS population, 'spark' AS engine, true AS named_source,
      'BETA=beta;CHR=chromosome;EA=effect_allele;EAF=effect_allele_frequency;NEA=other_allele;NEG_LOG10_P=neg_log_10_p_value;N_CASES=n_cases;N_CONTROLS=n_controls;OR=odds_ratio;OR_L95=ci_lower;OR_U95=ci_upper;P=p_value;POS=base_pair_location;RSID=rsid;SE=standard_error' AS column_mapping,
      'beta_from_or=false;n_from_metadata=true;se_from_ci=false' AS derived, (SELECT count(*) FROM derived) AS n_input, count(*) AS n_after_qc, (SELECT count(*) FROM derived) - count(*) AS n_removed,
      count(*) FILTER (P < 5e-8) AS n_significant, {r6('median(Z * Z) / 0.454936423119572::DOUBLE')} AS lambda_gc, {r6('avg((EAF IS NOT NULL)::INT)')} AS fraction_with_eaf,
      1.0::DOUBLE AS fraction_with_n, {r6('avg((RSID IS NOT NULL)::INT)')} AS fraction_with_rsid, NULL::DOUBLE AS n_cases, NULL::DOUBLE AS n_controls, 4321.0::DOUBLE AS n_total,
      'GRCh38' AS build, (SELECT 'checked ' || n FROM checked) AS build_validation, (SELECT {r6('share')} FROM checked) AS ref_concordance FROM final""",
)
def qc_record(spark, sf_dir):
    """All associations as one study's text: written as block-gzip, harmonised, checked against sequences, all fields of the record."""
    rows = views.assoc_text(spark, sf_dir)
    names = {
        "RSID": "rsid", "CHR": "chromosome", "POS": "base_pair_location", "EA": "effect_allele", "NEA": "other_allele", "BETA": "beta", "OR": "odds_ratio",
        "OR_L95": "ci_lower", "OR_U95": "ci_upper", "SE": "standard_error", "P": "p_value", "NEG_LOG10_P": "neg_log_10_p_value", "EAF": "effect_allele_frequency",
        "N_CASES": "n_cases", "N_CONTROLS": "n_controls",
    }
    path = folder(spark, "study")
    write_bgzf(with_header(rows.select(joined("\t", *names)), "\t".join(names.values())), path)
    panel = views.panel(spark, sf_dir).select("CHR", "POS", F.when(F.col("p_type") == "ECONOMY", "A").otherwise(F.col("REF")).alias("BASE"))
    analysis = harmonise.Analysis("whole_EUR", "whole", "trait", "EUR", "EUR", n_total=4321.0)
    record = harmonise.harmonise_file(spark, path, folder(spark, "harmonised"), analysis, form="bgzf", bases=panel, min_concordance=0.0)
    told = lambda c: F.array_join(F.array_sort(F.transform(F.map_entries(c), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string")))), ";").alias(c)
    check = F.col("build_validation")
    return record.select(
        "analysis_id", "study_accession", "population", "engine", (F.col("source_file") == path).alias("named_source"), told("column_mapping"), told("derived"), "n_input", "n_after_qc",
        "n_removed", "n_significant", "lambda_gc", "fraction_with_eaf", "fraction_with_n", "fraction_with_rsid", "n_cases", "n_controls", "n_total", "build",
        F.concat_ws(" ", check["status"], check["n_checked"]).alias("build_validation"), check["ref_concordance"].cast("double").alias("ref_concordance"),
    )


# ------------------------------------------------------------ panels and layouts


_PANEL_CTES = """pops AS (SELECT unnest(['EUR', 'AFR']) AS POPULATION),
  loci AS (SELECT 'L' || POPULATION || CHR AS LOCUS_ID, POPULATION, CHR, POS - 60000 AS START, POS + 60000 AS "END" FROM assoc WHERE POPULATION IN ('EUR', 'AFR', 'EAS')
    QUALIFY row_number() OVER (PARTITION BY POPULATION, CHR ORDER BY P, POS) = 1)"""


def write_panels(spark, sf_dir) -> str:
    """Panel text of two populations, read and stored as one partitioned table."""
    rows = views.panel(spark, sf_dir).select(F.concat(F.lit("chr"), "CHR").alias("CHROM"), "POS", "ID", F.lower("REF").alias("REF"), "ALT")
    frames = []
    for population in ("EUR", "AFR"):
        path = folder(spark, "pvar")
        with_header(rows.select(joined("\t", "CHROM", "POS", "ID", "REF", "ALT")), "##source=test\n#CHROM\tPOS\tID\tREF\tALT").write.text(path)
        frames.append(tables.read_panel_index(spark, path, population))
    return panel.write_panel(tables.union_tables(frames), folder(spark, "panel"))


@query(
    "panel_region",
    with_("assoc", "panel").rstrip() + f",\n{_PANEL_CTES}\n" + """SELECT LOCUS_ID, l.POPULATION, l.CHR, p.POS, p.ID, p.REF, p.ALT FROM loci AS l JOIN pops USING (POPULATION)
      JOIN panel AS p ON p.CHR = l.CHR AND p.POS BETWEEN l.START AND l."END" """,
)
def panel_region(spark, sf_dir):
    """Panel variants around the strongest association of each population and chromosome, from the partitioned panel."""
    assoc = views.assoc(spark, sf_dir).filter(F.col("POPULATION").isin("EUR", "AFR", "EAS")).select("POPULATION", "CHR", "POS", "P")
    best = assoc.withColumn("_R", F.row_number().over(Window.partitionBy("POPULATION", "CHR").orderBy("P", "POS"))).filter("_R = 1")
    loci = best.select(F.concat(F.lit("L"), "POPULATION", "CHR").alias("LOCUS_ID"), "POPULATION", "CHR", (F.col("POS") - 60000).alias("START"), (F.col("POS") + 60000).alias("END"))
    return panel.region_variants(panel.read_panel(spark, write_panels(spark, sf_dir)), checkpointed(loci))


@query(
    "panel_sizes",
    """SELECT POPULATION, (SELECT count(*) FROM part) AS N_VARIANTS, N_SAMPLES FROM (SELECT ['EUR', 'AFR', 'EAS', 'SAS', 'AMR'][c_custkey % 5 + 1] AS POPULATION, count(*) AS N_SAMPLES FROM customer GROUP BY 1)
      WHERE POPULATION IN ('EUR', 'AFR')""",
)
def panel_sizes(spark, sf_dir):
    """Variants of the stored panel and samples of a sample list, for each population."""
    populations = F.array(*[F.lit(p) for p in ("EUR", "AFR", "EAS", "SAS", "AMR")])
    listed = views.table(spark, sf_dir, "customer").select(F.concat(F.lit("HG"), "c_custkey").alias("sample "), F.get(populations, (F.col("c_custkey") % 5).cast("int")).alias("super_pop"))
    return tables.panel_counts(panel.read_panel(spark, write_panels(spark, sf_dir)), tables.panel_samples(listed, ["EUR", "AFR"]))


@query(
    "genome_order",
    with_("best") + f"SELECT POPULATION, VARIANT_ID, CHR, POS, {r6('BETA')} AS BETA, row_number() OVER (ORDER BY CHR, POS, VARIANT_ID, POPULATION) - 1 AS PLACE FROM best",
)
def genome_order(spark, sf_dir):
    """The stored table read back with the place of every row: files in the order of their ranges, rows in the order of their file."""
    path = folder(spark, "ordered")
    best = views.strongest(spark, sf_dir).select("POPULATION", "VARIANT_ID", "CHR", "POS", "BETA")
    export.write_clustered(best, path, ["CHR", "POS", "VARIANT_ID", "POPULATION"])
    rows = spark.read.parquet(path).select("*", F.col("_metadata.file_path").alias("FILE"), F.col("_metadata.row_index").alias("ROW"))
    key = F.struct("CHR", "POS", "VARIANT_ID", "POPULATION")
    before = Window.orderBy("_LOW").rowsBetween(Window.unboundedPreceding, -1)  # over files
    files = rows.groupBy("FILE").agg(F.min(key).alias("_LOW"), F.count("*").alias("_N")).select("FILE", F.coalesce(F.sum("_N").over(before), F.lit(0)).alias("_AHEAD"))
    return rows.join(files, "FILE").select("POPULATION", "VARIANT_ID", "CHR", "POS", "BETA", (F.col("_AHEAD") + F.col("ROW")).alias("PLACE"))


# ------------------------------------------------------------ catalogue as text


@query(
    "ancestry_rows",
    """WITH t AS (SELECT c_custkey AS k, 'GCST' || c_custkey % 700 AS study_accession, CASE WHEN c_custkey % 4 = 0 THEN NULL WHEN c_custkey % 4 = 1 THEN ' Initial' ELSE 'replication' END AS stage,
        CASE WHEN c_custkey % 6 = 0 THEN 'x' WHEN c_custkey % 6 = 1 THEN NULL ELSE 1000 + c_custkey || ',5' END AS n, c_custkey % 3 AS m, c_mktsegment FROM customer),
      u AS (SELECT *, unnest(CASE m WHEN 0 THEN ['European'] WHEN 1 THEN ['East Asian', 'NR', 'Other'] ELSE ['NR'] END) AS CATEGORY, generate_subscripts(CASE m WHEN 0 THEN ['European'] WHEN 1 THEN ['East Asian', 'NR', 'Other'] ELSE ['NR'] END, 1) - 1 AS SPOT FROM t)
    SELECT study_accession, lower(trim(coalesce(stage, 'unknown'))) AS STAGE, SPOT, CATEGORY, CASE WHEN SPOT = 0 AND n <> 'x' THEN CAST(replace(n, ',', '') AS BIGINT) END AS N, c_mktsegment AS COUNTRY,
      count(*) OVER () AS N_RECORDS FROM u WHERE study_accession <> 'GCST7'""",
)
def ancestry_rows(spark, sf_dir):
    """Ancestry text read with stable line numbers; N_RECORDS counts the different record numbers."""
    k = F.col("c_custkey")
    table = views.table(spark, sf_dir, "customer").select(
        F.concat(F.lit("GCST"), k % 700).alias("A"), F.when(k % 4 == 0, "").when(k % 4 == 1, " Initial").otherwise("replication").alias("B"),
        F.when(k % 6 == 0, "x").when(k % 6 == 1, "").otherwise(F.concat(k + 1000, F.lit(",5"))).alias("C"),
        F.when(k % 3 == 0, "European").when(k % 3 == 1, "East Asian,, NR ,Other").otherwise("NR").alias("D"), F.col("c_mktsegment").alias("E"),
    )
    path = folder(spark, "ancestry")
    with_header(table.select(joined("\t", *"ABCDE")), "STUDY ACCESSION\tSTAGE\tNUMBER OF INDIVIDUALS\tBROAD ANCESTRAL CATEGORY\tCOUNTRY OF RECRUITMENT").write.text(path)
    raw = catalog.read_ancestries(spark, path)
    raw = raw.select("LINE", *[F.nullif(F.col(f"`{c}`"), F.lit("")).alias(c) for c in raw.columns if c != "LINE"])
    studies = raw.select(F.col("STUDY ACCESSION").alias("study_accession")).filter("study_accession <> 'GCST7'")
    records = checkpointed(catalog.ancestry_records(raw, studies))
    total = records.agg(F.count_distinct("RECORD")).first()[0]
    return records.select("study_accession", "STAGE", (F.col("RECORD") % catalog.CATEGORIES_PER_LINE).alias("SPOT"), "CATEGORY", "N", "COUNTRY", F.lit(total).alias("N_RECORDS"))


@query(
    "catalog_text",
    """SELECT 'GCST' || lpad(CAST(c_custkey + 1 AS VARCHAR), 6, '0') AS study_accession, CASE WHEN c_custkey % 5 = 0 THEN '"' || c_mktsegment || ' 5" wide' ELSE c_mktsegment END AS reported_trait,
      CASE WHEN c_custkey % 3 > 0 THEN CAST(c_custkey AS VARCHAR) END AS pubmed_id, CASE WHEN c_custkey % 2 = 0 THEN 'x; ' || lower(c_mktsegment) ELSE lower(c_mktsegment) END AS labels,
      c_custkey % 7 = 0 AS gxe FROM customer""",
)
def catalog_text(spark, sf_dir):
    """A catalogue file with quotes as text, empty fields and lines that end early, as candidate studies."""
    k = F.col("c_custkey")
    table = views.table(spark, sf_dir, "customer").select(
        F.concat(F.lit("GCST"), F.lpad((k + 1).cast("string"), 6, "0")).alias("A"),
        F.when(k % 5 == 0, F.concat(F.lit('"'), "c_mktsegment", F.lit(' 5" wide'))).otherwise(F.col("c_mktsegment")).alias("B"),
        F.when(k % 3 > 0, k.cast("string")).alias("C"), F.concat(F.when(k % 2 == 0, "x, ").otherwise(""), F.lower("c_mktsegment")).alias("D"),
        F.when(k % 7 == 0, "YES ").when(k % 7 == 1, "no").alias("E"),
    )
    lines = table.select(F.regexp_replace(joined("\t", *"ABCDE"), "\t$", "").alias("value"))
    path = folder(spark, "catalogue")
    names = ("STUDY ACCESSION", "DISEASE/TRAIT", "PUBMED ID", "MAPPED_TRAIT", "GXE")
    with_header(lines, "\t".join(names)).coalesce(1).write.text(path)
    raw = catalog.read_catalog(spark, path).filter(F.col("STUDY ACCESSION") != "STUDY ACCESSION")
    more = ("MAPPED_TRAIT_URI", "MAPPED BACKGROUND TRAIT", "FIRST AUTHOR", "DATE", "COHORT", "INITIAL SAMPLE SIZE", "FULL SUMMARY STATISTICS", "SUMMARY STATS LOCATION")
    studies = catalog.candidate_studies(raw.withColumns({c: F.lit(None).cast("string") for c in more}), views.SUMSTATS_BASE)
    return studies.select("study_accession", "reported_trait", "pubmed_id", F.array_join("mapped_trait_labels", "; ").alias("labels"), "gxe")


@query(
    "consequence_text",
    with_("consequence") + "SELECT VARIANT_ID, CONSEQUENCE, GENE, 'ENSG' || GENE AS GENE_ID, FUNCTIONAL_CATEGORY FROM consequence",
)
def consequence_text(spark, sf_dir):
    """The consequence table as an annotator writes it, read back with its classes."""
    rows = views.consequence(spark, sf_dir).select("VARIANT_ID", "CONSEQUENCE", "GENE", F.concat(F.lit("ENSG"), "GENE").alias("ENSG"), F.lit("-").alias("EXTRA"))
    path = folder(spark, "consequence")
    with_header(rows.select(joined("\t", "VARIANT_ID", "ENSG", "EXTRA", "CONSEQUENCE", "GENE")), "## annotator 1\n#Uploaded_variation\tGene\tExtra\tConsequence\tSYMBOL").write.text(path)
    return tables.read_consequences(spark, path).filter("Extra is null").select("VARIANT_ID", "CONSEQUENCE", "GENE", "GENE_ID", "FUNCTIONAL_CATEGORY")


@query(
    "clump_text",
    with_("best") + f"SELECT CHR, POS AS LEAD_POS, VARIANT_ID AS LEAD_VARIANT, {r6('-log10(P)')} AS LEAD_NLP FROM best WHERE POPULATION = 'EUR'",
)
def clump_text(spark, sf_dir):
    """Leads as an outside clumping program lists them."""
    rows = views.strongest(spark, sf_dir).filter("POPULATION = 'EUR'").select("CHR", "POS", "VARIANT_ID", "P", F.lit(".").alias("T"))
    path = folder(spark, "clumps")
    with_header(rows.select(joined("\t", "CHR", "POS", "VARIANT_ID", "P", "T")), "#CHROM\tPOS\tID\tP\tTOTAL").write.text(path)
    return tables.read_clump_table(spark, path).select("CHR", "LEAD_POS", "LEAD_VARIANT", (-F.log10("LEAD_P")).alias("LEAD_NLP"))


@query(
    "stage_union",
    with_("best") + f"""SELECT POPULATION, VARIANT_ID, {r6('BETA')} AS BETA, CASE WHEN POPULATION = 'AFR' THEN N END AS N, CASE WHEN POPULATION <> 'AFR' THEN CHR END AS CHR FROM best""",
)
def stage_union(spark, sf_dir):
    """Stage tables whose columns differ, read in one scan."""
    best = checkpointed(views.strongest(spark, sf_dir).select("POPULATION", "VARIANT_ID", "BETA", "N", "CHR"))
    paths = [folder(spark, "stage") for _ in range(2)]
    export.write_parquet(best.filter("POPULATION = 'AFR'").select("POPULATION", "VARIANT_ID", "BETA", "N"), paths[0])
    export.write_parquet(best.filter("POPULATION <> 'AFR'").select("CHR", "VARIANT_ID", "BETA", "POPULATION"), paths[1])
    return tables.read_stage_tables(spark, paths).select("POPULATION", "VARIANT_ID", "BETA", "N", "CHR")


@query(
    "tsv_export",
    with_("catalog") + """SELECT study_accession || chr(9) || coalesce(cohorts, 'NA') || chr(9) || CAST(to_json(ids) AS VARCHAR) || chr(9) || k AS LINE, count(*) AS N FROM catalog GROUP BY 1
      UNION ALL SELECT 'study_accession' || chr(9) || 'cohort' || chr(9) || 'mapped_trait_ids' || chr(9) || 'k', 1""",
)
def tsv_export(spark, sf_dir):
    """Lines of a written table: lists as JSON, nulls as NA, a header."""
    studies = catalog.candidate_studies(views.catalog(spark, sf_dir), views.SUMSTATS_BASE)
    number = F.regexp_extract("study_accession", "([0-9]+)$", 1).cast("bigint") - 1
    rows = studies.select("study_accession", F.when(F.size("cohorts") > 0, F.array_join("cohorts", "; ")).alias("cohort"), "mapped_trait_ids", number.alias("k"))
    path = export.write_tsv(rows.coalesce(1), folder(spark, "tsv"))
    return spark.read.text(path).groupBy(F.col("value").alias("LINE")).agg(F.count("*").alias("N"))


@query("clump_files", with_("best") + f"SELECT CHR, VARIANT_ID, {r6('-log10(P)')} AS NLP FROM best WHERE P < 5e-8")
def clump_files(spark, sf_dir):
    """Clumping input written for each chromosome and read back by its folders."""
    rows = export.clump_export(harmonize.significant(views.strongest(spark, sf_dir)))
    path = export.write_table(rows, folder(spark, "clump-input"), partition_by=("CHR",))
    back = spark.read.schema("VARIANT_ID string, P double, CHR string").csv(path, sep="\t", header=True)
    return back.select("CHR", "VARIANT_ID", (-F.log10("P")).alias("NLP"))


# ---------------------------------------------------------- sample blocks of panels


@query("ld_pairs_blocked", with_("correlations") + f"SELECT POPULATION, ID_A, ID_B, {r6('R')} AS R FROM correlations WHERE ID_A < ID_B AND R * R >= 0.3")
def ld_pairs_blocked(spark, sf_dir):
    """The pairs of whole chromosomes from blocks of five samples: no row holds all samples, products are summed over the blocks."""
    blocks = ld_blocks.sample_blocks(views.dosage(spark, sf_dir), 5)
    units = checkpointed(ld_blocks.standardise_blocks(blocks, max_missing=None))
    return ld_blocks.ld_edges_blocked(units, min_r2=0.3, window_bp=None)


@query(
    "ld_eigenvalue",
    with_("correlations") + f"SELECT POPULATION || '|' || ID_A || '|' || ID_B AS SET_ID, {r6('1.0 - 0.9999 * abs(R)')} AS MIN_EIGENVALUE FROM correlations WHERE POS_B = POS_A + 5000",
)
def ld_eigenvalue(spark, sf_dir):
    """Smallest eigenvalue of every two neighbouring variants, which is one less their shrunk |r|."""
    units = checkpointed(ld_blocks.standardise_blocks(ld_blocks.sample_blocks(views.dosage(spark, sf_dir), 5), max_missing=None))
    ids = units.select("POPULATION", "CHR", "POS", "VARIANT_ID").distinct()
    after = ids.select("POPULATION", "CHR", (F.col("POS") - 5000).alias("POS"), F.col("VARIANT_ID").alias("NEXT_ID"))
    pairs = ids.join(after, ["POPULATION", "CHR", "POS"]).withColumn("SET_ID", F.concat_ws("|", "POPULATION", "VARIANT_ID", "NEXT_ID"))
    members = pairs.select("SET_ID", "POPULATION", F.explode(F.array("VARIANT_ID", "NEXT_ID")).alias("VARIANT_ID"))
    return ld_spectrum.smallest_eigenvalue(members, units).select("SET_ID", "MIN_EIGENVALUE")


# ------------------------------------------------------------------- sequences


_BASES = """bases AS (SELECT CHR, V // 22 + 1 AS SPOT, CASE WHEN p_type = 'ECONOMY' THEN 'A' ELSE REF END AS BASE FROM panel)"""
WIDTH = 60


def write_reference(spark, sf_dir) -> str:
    """A FASTA folder: the bases of the panel one after the other, a contig for each chromosome."""
    panel = views.panel(spark, sf_dir).select(
        "CHR", F.floor(F.col("V") / 22).alias("AT"), F.when(F.col("p_type") == "ECONOMY", "a").otherwise(F.lower("REF")).alias("BASE")
    )
    # A line is as long as the furthest base on it asks, and full where more lines follow.
    lines = panel.groupBy("CHR", F.floor(F.col("AT") / WIDTH).alias("L")).agg(F.map_from_entries(F.collect_list(F.struct("AT", "BASE"))).alias("M"), F.max("AT").alias("TOP"))
    ends = panel.groupBy("CHR").agg(F.floor(F.max("AT") / WIDTH).alias("LAST"))
    size = F.when(F.col("L") == F.col("LAST"), F.col("TOP") - F.col("L") * WIDTH + 1).otherwise(WIDTH)
    base = lambda i: F.coalesce(F.element_at("M", F.col("L") * WIDTH + i), F.lit("N"))
    full = lines.join(ends, "CHR").select("CHR", "L", F.array_join(F.transform(F.sequence(F.lit(0).cast("bigint"), size - 1), base), "").alias("value"))
    heads = ends.select("CHR", F.lit(-1).cast("bigint").alias("L"), F.concat(F.lit(">chr"), "CHR", F.lit(" of a test")).alias("value"))
    path = folder(spark, "fasta")
    heads.unionByName(full).repartition(FILES, "CHR").sortWithinPartitions("CHR", "L").select("value").write.text(path)
    return path


@query("fasta_index", with_("panel") + f"SELECT 'chr' || CHR AS CONTIG, CHR AS KEY, CAST({WIDTH} AS BIGINT) AS WIDTH, CAST(max(V // 22) + 1 AS BIGINT) AS LENGTH FROM panel GROUP BY CHR HAVING max(V // 22) + 1 >= {WIDTH}")
def fasta_index(spark, sf_dir):
    """Contigs of at least one full line."""
    index = fasta.fasta_index(fasta.read_fasta(spark, write_reference(spark, sf_dir)))
    return index.filter(F.col("LENGTH") >= WIDTH).select("CONTIG", "KEY", "WIDTH", "LENGTH")


@query(
    "build_from_fasta",
    with_("assoc", "panel").rstrip() + f",\n{_BASES}\n" + f"""SELECT POPULATION, count(*) AS N_CHECKED, {r6("avg(CASE WHEN BASE = EA OR BASE = NEA THEN 1.0 ELSE 0.0 END)")} AS REF_CONCORDANCE
      FROM assoc JOIN bases ON assoc.CHR = bases.CHR AND (assoc.POS - 10000) // 5000 + 1 = bases.SPOT GROUP BY 1""",
)
def build_from_fasta(spark, sf_dir):
    """Build check of all rows against sequences read from text."""
    lines = fasta.read_fasta(spark, write_reference(spark, sf_dir))
    placed = views.assoc(spark, sf_dir).withColumn("POS", F.expr("(POS - 10000) div 5000 + 1"))
    found = fasta.bases(placed, lines, fasta.fasta_index(lines)).filter("BASE <> 'N'")
    return harmonize.build_concordance(placed, found, ["POPULATION"])


@query(
    "fasta_spans",
    with_("panel").rstrip() + f",\n{_BASES}\n" + """SELECT s.CHR, s.SPOT AS START, CAST(70 AS BIGINT) AS SIZE, string_agg(coalesce(b.BASE, 'N'), '' ORDER BY i) AS BASES
      FROM (SELECT DISTINCT CHR, SPOT FROM bases) AS s, (SELECT unnest(range(70)) AS i) LEFT JOIN bases AS b ON b.CHR = s.CHR AND b.SPOT = s.SPOT + i
      JOIN (SELECT CHR, max(SPOT) AS top FROM bases GROUP BY 1) AS t ON t.CHR = s.CHR WHERE s.SPOT + 69 <= top GROUP BY 1, 2""",
)
def fasta_spans(spark, sf_dir):
    """The seventy bases from every panel variant on: spans over two lines or three."""
    lines = fasta.read_fasta(spark, write_reference(spark, sf_dir))
    spans = views.panel(spark, sf_dir).select("CHR", (F.floor(F.col("V") / 22) + 1).alias("START"), F.lit(70).cast("bigint").alias("SIZE"))
    return fasta.sequences(spans, lines, fasta.fasta_index(lines))
