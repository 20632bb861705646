"""Closed-form cases of the column expressions."""

import math

import pytest
from pyspark.sql import functions as F

from variantloom import schema
from variantloom.functions import statistics as S
from variantloom.functions import tails, text
from variantloom.functions import variants as V


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("z", [0.01, 0.3, 0.6, 0.67, 1.0, 3.0, 5.6, 5.7, 8.0, 20.0, 36.9])
def test_normal_tail(spark, z):
    exact = math.erfc(z / math.sqrt(2))
    assert one(spark, tails.two_sided_p(F.lit(z))) == pytest.approx(exact, rel=1e-12)
    assert one(spark, tails.neg_log10_two_sided_p(F.lit(-z))) == pytest.approx(-math.log10(exact), rel=1e-12)


@pytest.mark.parametrize("z", [50.0, 100.0])
def test_log_tail_survives_underflow(spark, z):
    series = 1 - 1 / z**2 + 3 / z**4 - 15 / z**6 + 105 / z**8
    log_p = math.log(2) - z * z / 2 - math.log(z * math.sqrt(2 * math.pi)) + math.log(series)
    assert one(spark, tails.neg_log10_two_sided_p(F.lit(z))) == pytest.approx(-log_p / math.log(10), rel=1e-10)
    assert one(spark, tails.two_sided_p(F.lit(None).cast("double"))) is None


def test_chi_square_tail(spark):
    q = 3.7
    x = q / 2
    expected = {
        1: math.erfc(math.sqrt(x)),
        2: math.exp(-x),
        3: math.erfc(math.sqrt(x)) + math.sqrt(x) * math.exp(-x) / math.gamma(1.5),
        4: math.exp(-x) * (1 + x),
    }
    for df, value in expected.items():
        assert one(spark, tails.chi_square_tail(F.lit(q), F.lit(df), 4)) == pytest.approx(value, rel=1e-12)
    assert one(spark, tails.chi_square_tail(F.lit(q), F.lit(0), 4)) is None


def test_chromosomes_alleles_and_ids(spark):
    rows = spark.createDataFrame([(" chr23 ",), ("CHRx",), ("M",), ("mt",), ("25",), ("7",), (None,)], "c string")
    assert [r[0] for r in rows.select(V.norm_chr("c")).collect()] == ["X", "X", "MT", "MT", "MT", "7", None]
    assert one(spark, V.parse_gtex_variant(F.lit("chr1_12_A_G_b38"))) == "1:12:A:G"
    assert one(spark, V.parse_gtex_variant(F.lit("23_0012_a_g"))) == "X:12:A:G"
    assert one(spark, V.parse_gtex_variant(F.lit("chr1_x_A_G"))) is None
    assert one(spark, V.parse_gtex_variant_strict(F.lit("chr1_12_A_G"))) is None
    assert one(spark, V.parse_gtex_variant_strict(F.lit("1_12_A_G_GRCh38"))) == "1:12:A:G"
    assert one(spark, V.allele_pair_key(F.lit("G"), F.lit("A"))) == "A/G"
    assert one(spark, V.allele_pair_key(F.lit("G"), F.lit(None))) is None
    assert one(spark, V.complement(F.lit("ACGTN"))) == "TGCAN"
    parts = V.split_variant_id(spark.createDataFrame([("1:12:A:G",)], "VARIANT_ID string")).first()
    assert (parts["CHR"], parts["POS"], parts["REF"], parts["ALT"]) == ("1", 12, "A", "G")


@pytest.mark.parametrize(
    "raw, value", [("1.5", 1.5), ("1e-8", 1e-8), ("NA", None), ("1.0d", None), ("2f", None), ("inf", math.inf), ("", None)]
)
def test_number(spark, raw, value):
    assert one(spark, V.number(F.lit(raw))) == value


def test_scores(spark):
    assert one(spark, S.effective_n(F.lit(100.0), F.lit(300.0))) == pytest.approx(300.0)
    assert one(spark, S.effective_n(F.lit(0.0), F.lit(300.0))) is None
    assert one(spark, S.sample_size_score(F.lit(None).cast("double"))) == 0.0
    assert one(spark, S.sample_size_score(F.lit(10_000))) == pytest.approx(4 / 7)
    assert [one(spark, S.splice_class(F.lit(v).cast("double"))) for v in (None, 0.1, 0.2, 0.5, 0.8)] == [
        "UNSCORED", "LOW", "HIGH_RECALL", "RECOMMENDED", "HIGH_PRECISION",
    ]
    values = spark.createDataFrame([(0.2,), (0.1,), (None,)], "v double")
    assert values.agg(S.any_of(F.col("v"))).first()[0] == pytest.approx(0.28)
    assert values.unionByName(spark.createDataFrame([(1.0,)], "v double")).agg(S.any_of(F.col("v"))).first()[0] == 1.0
    assert values.limit(0).agg(S.any_of(F.col("v"))).first()[0] == 0.0


def test_text(spark):
    assert one(spark, text.normalize_text(F.lit("  Type_2  Diabetes, (T2D)!"))) == "type 2 diabetes t2d"
    assert one(spark, text.normalize_reported(F.lit("Migraine (PheCode 340)"))) == "migraine"
    assert one(spark, text.reported_qualifiers(F.lit("Migraine (PheCode 340) [women]"))) == "PheCode 340 women"
    assert one(spark, text.is_stratified_subset(F.lit("Gout in Women"))) is True
    assert one(spark, text.is_stratified_subset(F.lit("Womenfolk"))) is False
    assert one(spark, text.canonical_term_id(F.lit("http://x/obo/MONDO:0005277"))) == "MONDO_0005277"
    assert one(spark, text.slugify(F.lit("  Crohn's disease "))) == "crohn_s_disease"


def test_header_mapping_and_schema(spark):
    mapping = schema.map_columns(["#CHROM", "POS", "ID", "REF", "ALT", "beta", "hm_beta", "SE", "P"])
    assert mapping["BETA"] == "hm_beta" and mapping["EA"] == "ALT" and mapping["NEA"] == "REF" and mapping["RSID"] == "ID"
    flags = schema.capabilities(mapping)
    assert flags["has_alleles"] and flags["has_se"] and not flags["has_or"]
    assert schema.validate(schema.empty_table(spark)) == []
    problems = schema.validate(spark.createDataFrame([("1", "2")], "CHR string, POS string"))
    assert "missing column STUDY_ID" in problems and "POS has type string, expected bigint" in problems
