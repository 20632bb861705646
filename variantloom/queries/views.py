"""Association-shaped views of the driver's star-schema tables.

Everything is derived column by column from the whole tables; no row is left
out except where the view's own meaning says so.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from variantloom.functions import variants as V
from variantloom.operators.annotation import CONSEQUENCE_CLASSES, functional_category
from variantloom.operators.finemap import single_effect_posterior
from variantloom.operators.harmonize import keep_strongest
from variantloom.operators.ld import standardise
from variantloom.operators.qtl import normalise_qtl
from variantloom.operators.region import match_to_reference
from variantloom.schema import SUPERPOPULATIONS
from variantloom.session import checkpointed, stored

FIRST_ALLELES, SECOND_ALLELES = "ACAGAC", "GTCTTG"
TIES = ("EA", "BETA", "SE", "EAF", "N", "N_CASES", "N_CONTROLS")
TERMS = [term for members in CONSEQUENCE_CLASSES.values() for term in members]
SAMPLES_PER_POPULATION = 13
SUMSTATS_BASE = "https://example.org/statistics"
REGION_CATEGORY = {
    "AFRICA": "Sub-Saharan African",
    "AMERICA": "Hispanic or Latin American",
    "ASIA": "East Asian",
    "EUROPE": "European",
    "MIDDLE EAST": "Greater Middle Eastern (Middle Eastern, North African or Persian)",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _chr(v: Column) -> Column:
    return (v % 22 + 1).cast("string")


def _pos(v: Column) -> Column:
    return (F.floor(v / 22) * 5000 + 10000).cast("bigint")


def _letter(alleles: str, v: Column) -> Column:
    return F.substring(F.lit(alleles), (v % 6 + 1).cast("int"), F.lit(1))


def assoc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw associations: about six rows per variant and population."""
    li = table(spark, sf_dir, "lineitem")
    v = F.col("l_partkey")
    code = F.col("l_suppkey") % 5
    population = F.when(code == 0, "EUR").when(code == 1, "AFR").when(code == 2, "EAS").when(code == 3, "SAS").otherwise("AMR")
    even = F.col("l_linenumber") % 2 == 0
    first, second = _letter(FIRST_ALLELES, v), _letter(SECOND_ALLELES, v)
    known = F.col("l_linenumber") != 6
    base = li.select(
        F.concat(F.lit("study_"), population).alias("STUDY_ID"),
        population.alias("POPULATION"),
        _chr(v).alias("CHR"),
        _pos(v).alias("POS"),
        F.concat(F.lit("rs"), v.cast("string")).alias("RSID"),
        F.when(even, first).otherwise(second).alias("EA"),
        F.when(even, second).otherwise(first).alias("NEA"),
        ((F.col("l_quantity") - 25.5) / 100.0).alias("BETA"),
        (F.lit(0.02) + F.col("l_discount") / 2.0).alias("SE"),
        F.when(F.col("l_linenumber") != 7, F.lit(0.05) + F.col("l_tax") * 5.0).alias("EAF"),
        F.when(known, F.col("l_orderkey") % 5000 + 100).cast("double").alias("N_CASES"),
        F.when(known, F.col("l_orderkey") % 9000 + 500).cast("double").alias("N_CONTROLS"),
        "l_returnflag", "l_linestatus", "l_linenumber", "l_tax",
    )
    z = F.col("BETA") / F.col("SE")
    q = 1.0 + z * z / 2.0
    q4 = (q * q) * (q * q)
    return base.withColumns(
        {
            "P": 1.0 / (q4 * q4),
            "N": F.col("N_CASES") + F.col("N_CONTROLS"),
            "N_EFF": F.lit(4.0) / (1.0 / F.col("N_CASES") + 1.0 / F.col("N_CONTROLS")),
            "VARIANT_ID": V.pair_variant_id(),
        }
    )


def assoc_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows as a submitter would send them: text, prefixes, lower case, odds ratios.

    Returned lines carry an odds ratio with a confidence interval instead of an
    effect; the highest tax marks an unreadable allele.
    """
    a = assoc(spark, sf_dir)
    as_odds = F.col("l_returnflag") == "R"
    with_ci = as_odds & (F.col("l_linestatus") == "F")
    text = lambda column: column.cast("string")
    half = 1.959963984540054 * F.col("SE")
    return a.select(
        "STUDY_ID", "POPULATION", F.concat(F.lit(" chr"), "CHR").alias("CHR"), text(F.col("POS")).alias("POS"), "RSID",
        F.when(F.col("l_tax") >= 0.08, "n").otherwise(F.lower("EA")).alias("EA"), "NEA",
        F.when(~as_odds, text(F.col("BETA"))).alias("BETA"),
        F.when(as_odds, text(F.exp("BETA"))).alias("OR"),
        F.when(with_ci, text(F.exp(F.col("BETA") - half))).alias("OR_L95"),
        F.when(with_ci, text(F.exp(F.col("BETA") + half))).alias("OR_U95"),
        F.when(~with_ci, text(F.col("SE"))).otherwise("NA").alias("SE"),
        F.when(~F.col("l_linenumber").isin(3, 4), text(F.col("P"))).alias("P"),
        F.when(F.col("l_linenumber") == 4, text(F.abs(F.col("BETA") / F.col("SE")))).alias("NEG_LOG10_P"),
        text(F.col("EAF")).alias("EAF"), text(F.col("N_CASES")).alias("N_CASES"), text(F.col("N_CONTROLS")).alias("N_CONTROLS"),
    )


def strongest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_strongest(assoc(spark, sf_dir), ["POPULATION", "VARIANT_ID"], TIES)


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    v = F.col("p_partkey")
    first, second = _letter(FIRST_ALLELES, v), _letter(SECOND_ALLELES, v)
    odd = F.col("p_size") % 2 == 1
    rows = p.select(
        v.alias("V"), _chr(v).alias("CHR"), _pos(v).alias("POS"), F.when(odd, second).otherwise(first).alias("REF"),
        F.when(odd, first).otherwise(second).alias("ALT"), "p_size", "p_retailprice", "p_type", "p_name", "p_brand",
    )
    return rows.withColumn("ID", V.variant_id())


def matched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Panel-oriented associations per population, with one locus per chromosome."""
    rows = match_to_reference(assoc(spark, sf_dir), panel(spark, sf_dir).select("CHR", "POS", "ID", "REF", "ALT"), ["POPULATION"], TIES)
    return rows.withColumn("LOCUS_ID", F.concat(F.lit("L"), "CHR")).withColumn("Z", F.col("Z_ALT"))


def finemapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Single-effect posteriors as a stored stage: later steps read it several times."""
    stage = stored(matched(spark, sf_dir).select("LOCUS_ID", "POPULATION", "VARIANT_ID", "CHR", "POS", "REF", "ALT", "Z"))
    rows = single_effect_posterior(stage)
    return stored(rows.withColumnRenamed("ALPHA", "PIP"))


def dosage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each population owns a run of the vector's elements as its samples; outliers are missing calls."""
    e = table(spark, sf_dir, "embeddings")
    populations = F.array(*[F.struct(F.lit(i).alias("AT"), F.lit(p).alias("P")) for i, p in enumerate(SUPERPOPULATIONS)])
    rows = e.select("vec_id", "embedding", F.explode(populations).alias("S")).select(
        F.col("vec_id").alias("V"), F.col("S.P").alias("POPULATION"),
        F.transform(
            F.slice("embedding", F.col("S.AT") * SAMPLES_PER_POPULATION + 1, F.lit(SAMPLES_PER_POPULATION)),
            lambda x: F.when(F.abs(x.cast("double")) <= 0.35, x.cast("double") + 1.0),
        ).alias("DOSAGE"),
    )
    ids = panel(spark, sf_dir).select("V", "CHR", "POS", F.col("ID").alias("VARIANT_ID"))
    return rows.join(ids, "V").select("POPULATION", "CHR", "POS", "VARIANT_ID", "DOSAGE")


def units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unit dosage vectors as a stored stage."""
    return checkpointed(standardise(dosage(spark, sf_dir), max_missing=None))


def qtl_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    kind = F.col("event_id") % 3
    ids = panel(spark, sf_dir).select("V", V.gtex_variant_id().alias("variant_id"))
    return e.join(ids, e["user_id"] == ids["V"]).select(
        "variant_id", F.concat(F.lit("GENE"), (F.col("event_id") % 40).cast("string")).alias("gene_id"),
        F.when(F.col("event_id") % 17 != 0, F.col("value") / (F.col("value") + 100.0)).cast("string").alias("pip"),
        F.col("event_type").alias("TISSUE"),
        F.when(kind == 0, "eQTL").when(kind == 1, "sQTL").otherwise("apaQTL").alias("QTL_TYPE"),
    )


def qtl(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalise_qtl(qtl_raw(spark, sf_dir), F.col("TISSUE"), F.col("QTL_TYPE"))


def consequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = panel(spark, sf_dir)
    terms = F.array(*[F.lit(t) for t in TERMS])
    n = len(TERMS)
    at = lambda step: F.element_at(terms, ((F.col("V") + F.col("K") * 7 + step) % n + 1).cast("int"))
    rows = p.select("V", F.col("ID").alias("VARIANT_ID"), "p_size", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("K"))
    text = F.when(F.col("p_size") % 3 == 0, F.concat(at(0), F.lit("&"), at(11))).otherwise(at(0))
    return rows.select(
        "VARIANT_ID", text.alias("CONSEQUENCE"), F.concat(F.lit("GENE"), ((F.col("V") + F.col("K")) % 40).cast("string")).alias("GENE")
    ).withColumn("FUNCTIONAL_CATEGORY", functional_category("CONSEQUENCE"))


def spliceai_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """VCF lines; promotional parts have no prediction, small ones no id of their own."""
    p = panel(spark, sf_dir)
    score = lambda step: (((F.col("p_size") + step) % 51) / 51.0).cast("string")
    record = lambda gene, step: F.concat_ws(
        "|", "ALT", gene, score(step), F.lit("."), score(step + 9), score(step + 20), F.lit("1"), F.lit("-2"), F.lit("3"), F.lit("-4")
    )
    gene = F.concat(F.lit("GENE"), (F.col("V") % 40).cast("string"))
    other = F.concat(F.lit("GENE"), ((F.col("V") + 3) % 40).cast("string"))
    info = F.when(F.col("p_type") == "PROMO", "AC=2").otherwise(
        F.concat(F.lit("AC=2;SpliceAI="), record(gene, 0), F.lit(","), record(other, 5), F.lit(",broken|record"))
    )
    return p.select(
        F.concat_ws(
            "\t", "CHR", F.col("POS").cast("string"), F.when(F.col("p_type") == "SMALL", ".").otherwise(F.col("ID")), "REF", "ALT",
            F.lit("."), F.lit("PASS"), info,
        ).alias("value")
    )


PANGOLIN_HEADER = "CHROM,POS,REF,ALT,REFERENCE_ID,Pangolin"


def pangolin_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV lines with unquoted commas in the last field; large parts were not scored."""
    p = panel(spark, sf_dir)
    cents = (F.col("p_retailprice") % 100.0) / 100.0
    gene = F.concat(F.lit("GENE"), (F.col("V") % 40).cast("string"))
    first = F.concat(gene, F.lit("|12:"), cents.cast("string"), F.lit("|-3:-"), ((F.col("p_size") % 7) / 10.0).cast("string"), F.lit("|Warnings:"))
    second = F.concat(gene, F.lit("B|2:0.01|5:none|"))
    scored = F.when(F.col("p_type") == "LARGE", "").otherwise(F.concat(first, F.lit(","), second))
    return p.select(F.concat_ws(",", "CHR", F.col("POS").cast("string"), "REF", "ALT", "ID", scored).alias("value"))


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Study catalogue rows from customers and their regions."""
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    k = F.col("c_custkey")
    segment = F.initcap("c_mktsegment")
    reported = (
        F.when(k % 11 == 0, F.concat(segment, F.lit(" (females)")))
        .when(k % 7 == 0, F.concat(segment, F.lit(" disorder [adjusted]")))
        .otherwise(segment)
    )
    uri = lambda s: F.concat(F.lit("http://purl.example/obo/EFO_"), F.length(s).cast("string"))
    second = k % 5 == 0
    return c.join(n, c["c_nationkey"] == n["n_nationkey"]).join(r, n["n_regionkey"] == r["r_regionkey"]).select(
        F.concat(F.lit("GCST"), F.lpad((k + 1).cast("string"), 6, "0")).alias("STUDY ACCESSION"),
        reported.alias("DISEASE/TRAIT"),
        F.when(second, F.concat(F.lower("c_mktsegment"), F.lit(", "), F.lower("r_name"))).otherwise(F.lower("c_mktsegment")).alias("MAPPED_TRAIT"),
        F.when(second, F.concat(uri(F.col("c_mktsegment")), F.lit(", "), uri(F.col("r_name")))).otherwise(uri(F.col("c_mktsegment"))).alias("MAPPED_TRAIT_URI"),
        F.when(k % 23 == 0, "smoking").alias("MAPPED BACKGROUND TRAIT"),
        F.when(k % 3 != 0, k.cast("string")).alias("PUBMED ID"),
        F.lit("Author A").alias("FIRST AUTHOR"), F.lit("2020-01-01").alias("DATE"),
        F.when(k % 2 == 0, F.concat(F.lit("BIO|"), F.col("n_name"))).alias("COHORT"),
        F.concat((k % 977 * 10).cast("string"), F.lit(" European ancestry cases, "), (k % 1999 * 10).cast("string"), F.lit(" European ancestry controls")).alias("INITIAL SAMPLE SIZE"),
        F.when(k % 29 == 0, "yes").otherwise("no").alias("GXE"),
        F.when(F.col("c_acctbal") >= 0, "yes").otherwise("no").alias("FULL SUMMARY STATISTICS"),
        F.lit(None).cast("string").alias("SUMMARY STATS LOCATION"),
        k.alias("K"), "r_name", "n_name", "c_acctbal",
    )


def ancestry_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sample descriptions such as ``1,234 European (NATION_3), Other``."""
    c = catalog(spark, sf_dir)
    mapping = F.create_map(*[part for name, cat in REGION_CATEGORY.items() for part in (F.lit(name), F.lit(cat))])
    category = F.element_at(mapping, F.col("r_name"))
    count = F.format_number(F.col("K") + 1000, 0)
    text = (
        F.when(F.col("K") % 4 == 0, F.concat(count, F.lit(" "), category, F.lit(" ("), "n_name", F.lit("), East Asian (Japan)")))
        .when(F.col("K") % 4 == 1, F.concat(count, F.lit(" "), category))
        .when(F.col("K") % 4 == 2, F.concat(category, F.lit(" ("), "n_name", F.lit("), Martian (Base 1)")))
        .otherwise("NR")
    )
    return c.select(F.col("STUDY ACCESSION").alias("study_accession"), text.alias("TEXT"))


def file_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of each study, from the orders of the customer."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    acc = F.concat(F.lit("GCST"), F.lpad((F.col("o_custkey") + 1).cast("string"), 6, "0"))
    harmonised = F.col("o_orderstatus") == "F"
    name = (
        F.when(F.substring("o_orderpriority", 1, 1) == "5", F.concat(acc, F.lit("-meta.yaml")))
        .when(F.substring("o_orderpriority", 1, 1) == "4", "md5sum.txt")
        .when(harmonised, F.concat(acc, F.lit(".h.tsv.gz")))
        .when(k % 2 == 0, F.concat(acc, F.lit("_buildGRCh37.tsv")))
        .otherwise(F.concat(acc, F.lit("_buildGRCh38.txt.gz")))
    )
    wide = F.array(*[F.lit(h) for h in ("chromosome", "base_pair_location", "effect_allele", "other_allele", "beta", "standard_error", "p_value", "n")])
    slim = F.array(*[F.lit(h) for h in ("SNP", "A1", "OR", "P", "Freq")])
    return o.select(
        acc.alias("study_accession"), k.alias("ORD"), name.alias("filename"), harmonised.alias("in_harmonised"),
        F.concat(F.lit("ftp://files/"), acc, F.lit("/"), name).alias("url"),
        F.when(F.col("o_totalprice") > 250000, slim).otherwise(wide).alias("header_columns"),
        (F.col("o_totalprice") < 400000).alias("is_probed"), (k % 1000).alias("probe_bytes"),
    )
