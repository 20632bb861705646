"""Variant identity: chromosomes, alleles, ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANKS = " \t\r\n"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


# What stands for a missing number; Java would raise and catch an error for each.
NO_NUMBERS = ("", ".", "-", "NA", "na", "N/A", "n/a", "NULL", "null", "None")


def number(value: Column | str) -> Column:
    """Text to double, null when it is not a number.

    Java also reads a trailing d or f as a type suffix; that is not a number
    here, while ``inf`` is.
    """
    text = _col(value).cast("string")
    parsed = text.try_cast("double")
    infinite = F.lower(text).isin("inf", "+inf", "-inf")
    suffixed = F.substring(text, -1, 1).isin("d", "D", "f", "F")
    return F.when(text.isin(*NO_NUMBERS), None).when(suffixed, F.when(infinite, parsed)).otherwise(parsed)


# Numeric and short chromosome codes.
CHROMOSOME_NAMES = {"23": "X", "24": "Y", "25": "MT", "M": "MT"}


def norm_chr(value: Column | str) -> Column:
    """Trimmed, without ``chr``, sex and mitochondrial codes spelt out, upper case."""
    raw = F.upper(F.btrim(_col(value).cast("string"), F.lit(BLANKS)))
    base = F.when(raw.startswith("CHR"), F.substring(raw, 4, 1_000_000)).otherwise(raw)
    names = F.create_map(*[F.lit(part) for pair in CHROMOSOME_NAMES.items() for part in pair])
    return F.coalesce(F.element_at(names, base), base)


def norm_allele(value: Column | str) -> Column:
    return F.upper(F.btrim(_col(value).cast("string"), F.lit(BLANKS)))


def is_valid_dna(value: Column | str) -> Column:
    return _col(value).rlike("^[ACGT]+$")


def variant_id(chrom="CHR", pos="POS", ref="REF", alt="ALT") -> Column:
    """``CHR:POS:REF:ALT``; null when any part is null (``concat``, not ``concat_ws``)."""
    return F.concat(
        _col(chrom), F.lit(":"), _col(pos).cast("string"), F.lit(":"), _col(ref), F.lit(":"), _col(alt)
    )


def gtex_variant_id(chrom="CHR", pos="POS", ref="REF", alt="ALT") -> Column:
    """``chr1_12345_A_G_b38``."""
    return F.concat(
        F.lit("chr"), _col(chrom), F.lit("_"), _col(pos).cast("string"), F.lit("_"), _col(ref), F.lit("_"),
        _col(alt), F.lit("_b38"),
    )


def parse_gtex_variant_strict(value: Column | str) -> Column:
    """Strict form: DNA alleles and a build suffix are required."""
    text = _col(value)
    pattern = r"^(?:chr)?([^_]+)_(\d+)_([ACGTN]+)_([ACGTN]+)_(?:b38|GRCh38)$"
    part = [F.regexp_extract(text, pattern, group) for group in (1, 2, 3, 4)]
    return F.when(text.rlike(pattern), variant_id(norm_chr(part[0]), part[1], part[2], part[3]))


def parse_gtex_variant(value: Column | str) -> Column:
    """Lenient form used for QTL tables: any alleles, build optional."""
    parts = F.split(F.regexp_replace(_col(value), r"(?s)^(.*?)chr", "$1"), "_")
    pos = F.get(parts, F.lit(1))
    return F.when(
        (F.size(parts) >= 4) & pos.rlike(r"^\d+$"),
        variant_id(
            norm_chr(F.get(parts, F.lit(0))),
            F.regexp_replace(pos, r"^0+(?=\d)", ""),
            F.upper(F.get(parts, F.lit(2))),
            F.upper(F.get(parts, F.lit(3))),
        ),
    )


def split_variant_id(df: DataFrame, column: str = "VARIANT_ID") -> DataFrame:
    parts = F.split(F.col(column), ":")
    return df.withColumns(
        {
            "CHR": F.get(parts, F.lit(0)),
            "POS": F.get(parts, F.lit(1)).try_cast("bigint"),
            "REF": F.get(parts, F.lit(2)),
            "ALT": F.get(parts, F.lit(3)),
        }
    )


def allele_pair_key(a: Column | str, b: Column | str, sep: str = "/") -> Column:
    """Alleles in sorted order; null when either is null (``least`` skips nulls)."""
    left, right = _col(a), _col(b)
    return F.when(
        left.isNotNull() & right.isNotNull(),
        F.concat(F.least(left, right), F.lit(sep), F.greatest(left, right)),
    )


def pair_variant_id(chrom="CHR", pos="POS", a="EA", b="NEA") -> Column:
    """Order-free association id ``CHR:POS:lo:hi``."""
    return F.concat(
        _col(chrom), F.lit(":"), _col(pos).cast("string"), F.lit(":"), allele_pair_key(a, b, ":")
    )


def is_palindromic(a: Column | str, b: Column | str) -> Column:
    return F.concat(_col(a), _col(b)).isin("AT", "TA", "CG", "GC")


def complement(value: Column | str) -> Column:
    return F.translate(F.upper(_col(value)), "ACGT", "TGCA")
