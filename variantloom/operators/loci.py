"""LD clumping and locus construction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from variantloom.functions import statistics as S
from variantloom.plans.ordered import merge_intervals
from variantloom.session import checkpointed

LOCUS_KEYS = ("POPULATION", "CHR")


def clump_leads(index: DataFrame, edges: DataFrame) -> DataFrame:
    """Leads of greedy clumping, found in rounds instead of one by one.

    ``index`` is (POPULATION, VARIANT_ID, P) of the variants that may lead;
    ``edges`` is (POPULATION, ID_A, ID_B) between variants in each other's reach.
    In a round, every undecided variant without a better-ranked undecided
    neighbour is a lead and covers its neighbours.  The rank (P, VARIANT_ID) is
    total, so the answer is that of the sequential procedure.
    """
    numbered = _numbered(index.select("POPULATION", "VARIANT_ID", "P"))
    met = _between(edges, numbered.select("POPULATION", "VARIANT_ID", "_K"), numbered.select("POPULATION", "VARIANT_ID", "_K"))
    covered = _covered(checkpointed(met.filter("_A < _B").select("_A", "_B")))
    if covered is None:
        return index
    names = numbered.join(covered, "_K").select("POPULATION", "VARIANT_ID")
    return index.join(names, ["POPULATION", "VARIANT_ID"], "left_anti")


def _numbered(variants: DataFrame) -> DataFrame:
    """``variants`` with _K, which grows with the rank (P, VARIANT_ID), stored."""
    return checkpointed(variants.orderBy("P", "VARIANT_ID", "POPULATION").withColumn("_K", F.monotonically_increasing_id()))


def _between(edges: DataFrame, first: DataFrame, second: DataFrame) -> DataFrame:
    """Edges with the numbers _A and _B of their ends; other columns of ``first`` and ``second`` get the same endings."""
    ends = [
        side.select("POPULATION", *[F.col(c).alias({"VARIANT_ID": f"ID{end}", "_K": end}.get(c, c + end)) for c in side.columns if c != "POPULATION"])
        for side, end in ((first, "_A"), (second, "_B"))
    ]
    return edges.select("POPULATION", "ID_A", "ID_B").join(ends[0], ["POPULATION", "ID_A"]).drop("ID_A").join(ends[1], ["POPULATION", "ID_B"]).drop("ID_B")


def _covered(open_edges: DataFrame) -> DataFrame | None:
    """(_K): numbers of the variants that a lead covers; edges are (_A, _B), the better first."""
    covered: DataFrame | None = None
    while not open_edges.isEmpty():
        blocked = open_edges.select(F.col("_B").alias("_A")).distinct()
        newly = checkpointed(open_edges.join(blocked, "_A", "left_anti").select(F.col("_B").alias("_K")).distinct())
        # All edges of a lead end at variants that it covers, so they go with these.
        open_edges = checkpointed(
            open_edges.join(newly.withColumnRenamed("_K", "_A"), "_A", "left_anti").join(newly.withColumnRenamed("_K", "_B"), "_B", "left_anti")
        )
        covered = newly if covered is None else covered.unionByName(newly)
    return covered


def clump_members(
    variants: DataFrame,
    edges: DataFrame,
    p1: float = 5e-8,
    p2: float = 1.0,
    r2: float = 0.1,
    kb: int = 1000,
) -> DataFrame:
    """Long clump table: LEAD_VARIANT and VARIANT_ID, the lead included.

    ``variants`` is (POPULATION, CHR, POS, P, VARIANT_ID); ``edges`` carries R
    from index variants to any variant.  A member belongs to its best-ranked
    neighbouring lead, the one that claims it first in the greedy order.  Ids meet
    their variants once; from then on edges are pairs of numbers in the order of rank.
    """
    usable = _numbered(variants.filter(S.is_finite("P") & (F.col("P") <= p2)).select("POPULATION", "CHR", "POS", "P", "VARIANT_ID"))
    index = usable.filter(F.col("P") <= p1)
    linked = edges.filter((F.col("R") * F.col("R") >= r2) & (F.col("ID_A") != F.col("ID_B")))
    placed = ["POPULATION", "VARIANT_ID", "_K", "CHR", "POS"]
    near = (F.col("CHR_A") == F.col("CHR_B")) & (F.abs(F.col("POS_A") - F.col("POS_B")) <= kb * 1000)
    reach = checkpointed(
        _between(linked, index.select(*placed), usable.select(*placed, (F.col("P") <= p1).alias("_LEADS"))).filter(near).select("_A", "_B", "_LEADS_B")
    )
    covered = _covered(reach.filter("_LEADS_B and _A < _B").select("_A", "_B"))
    leads = checkpointed(index if covered is None else index.join(covered, "_K", "left_anti"))
    numbers = leads.select("_K")
    claims = (
        reach.join(numbers.withColumnRenamed("_K", "_A"), "_A").join(numbers.withColumnRenamed("_K", "_B"), "_B", "left_anti")
        .groupBy("_B").agg(F.min("_A").alias("_A"))
    )
    claimed = claims.join(usable.select(F.col("_K").alias("_B"), "VARIANT_ID"), "_B").select("_A", "VARIANT_ID")
    own = leads.select(F.col("_K").alias("_A"), "VARIANT_ID")
    facts = leads.select(
        F.col("_K").alias("_A"), "POPULATION", F.col("VARIANT_ID").alias("LEAD_VARIANT"), "CHR", F.col("POS").alias("LEAD_POS"), F.col("P").alias("LEAD_P")
    )
    return claimed.unionByName(own).join(facts, "_A").select("POPULATION", "LEAD_VARIANT", "VARIANT_ID", "CHR", "LEAD_POS", "LEAD_P")


def clumps(members: DataFrame) -> DataFrame:
    """One row per lead with its member count."""
    return members.groupBy("POPULATION", "LEAD_VARIANT").agg(
        F.first("CHR").alias("CHR"), F.first("LEAD_POS").alias("LEAD_POS"), F.first("LEAD_P").alias("LEAD_P"),
        F.count("*").alias("N_MEMBERS"),
    )


def with_member_lists(table: DataFrame, members: DataFrame, keys: list[str], value: str, out: str, order: list[str]) -> DataFrame:
    """Export form: the members of each row as an array in a fixed order.

    Lists grow with a locus; the long member table is the scalable form and is
    what the other operators read.
    """
    lists = members.groupBy(*keys).agg(
        F.transform(F.array_sort(F.collect_list(F.struct(*order, F.col(value).alias("_V")))), lambda s: s["_V"]).alias(out)
    )
    return table.join(lists, keys, "left")


def hits_as_leads(significant: DataFrame) -> DataFrame:
    """Every significant variant as a lead: the form for meta-analysis hits, which have no LD panel."""
    return significant.select(
        "POPULATION", "CHR", F.col("POS").alias("LEAD_POS"), F.col("VARIANT_ID").alias("LEAD_VARIANT"), F.col("P").alias("LEAD_P")
    )


def _windows(leads: DataFrame, window_bp: int) -> DataFrame:
    pos = F.col("LEAD_POS")
    return leads.select(
        *LOCUS_KEYS, F.greatest(F.lit(1), pos - window_bp).alias("START"), (pos + window_bp).alias("END"),
        "LEAD_POS", "LEAD_VARIANT", "LEAD_P",
    )


def _locus_id():
    return F.concat(
        "POPULATION", F.lit(":"), "CHR", F.lit(":"), F.col("START").cast("string"), F.lit("-"), F.col("END").cast("string")
    )


def _merged(intervals: DataFrame, gap: int, bin_bp: int) -> tuple[DataFrame, DataFrame]:
    """Loci, and the START -> LOCUS_ID map of the intervals that formed them."""
    facts = {"LEAD_P": F.min("LEAD_P"), "_LEADS": F.sum("_LEADS")}
    islands = merge_intervals(intervals, LOCUS_KEYS, gap, bin_bp, facts)
    loci = (
        islands.groupBy(*LOCUS_KEYS, "ISLAND_START")
        .agg(F.max("END").alias("END"), F.sum("_LEADS").alias("N_LEADS"), F.min("LEAD_P").alias("LEAD_P"))
        .withColumnRenamed("ISLAND_START", "START")
        .select(_locus_id().alias("LOCUS_ID"), *LOCUS_KEYS, "START", "END", "N_LEADS", "LEAD_P")
    )
    places = islands.join(
        loci.select(*LOCUS_KEYS, F.col("START").alias("ISLAND_START"), "LOCUS_ID"), [*LOCUS_KEYS, "ISLAND_START"]
    ).select(*LOCUS_KEYS, "START", "LOCUS_ID")
    return loci, places


def construct_loci(
    leads: DataFrame, window_bp: int = 1_000_000, merge_gap_bp: int = 0, bin_bp: int = 1_000_000
) -> DataFrame:
    """Lead positions widened by a window and merged per population and chromosome."""
    windows = _windows(leads, window_bp).withColumn("_LEADS", F.lit(1))
    return _merged(windows, merge_gap_bp, bin_bp)[0]


def locus_members(
    leads: DataFrame, window_bp: int = 1_000_000, merge_gap_bp: int = 0, bin_bp: int = 1_000_000
) -> DataFrame:
    """Long form of the loci: one row per lead with the locus it fell into."""
    windows = _windows(leads, window_bp).withColumn("_LEADS", F.lit(1))
    places = _merged(windows, merge_gap_bp, bin_bp)[1]
    return windows.join(places, [*LOCUS_KEYS, "START"]).select("LOCUS_ID", *LOCUS_KEYS, "LEAD_VARIANT", "LEAD_POS", "LEAD_P")


def loci_with_lead_lists(leads: DataFrame, window_bp: int = 1_000_000, merge_gap_bp: int = 0) -> DataFrame:
    """Export form with LEAD_VARIANTS listed by position."""
    loci = construct_loci(leads, window_bp, merge_gap_bp)
    members = locus_members(leads, window_bp, merge_gap_bp)
    return with_member_lists(
        loci, members, ["LOCUS_ID"], "LEAD_VARIANT", "LEAD_VARIANTS", ["LEAD_POS", "LEAD_VARIANT"]
    ).select("LOCUS_ID", *LOCUS_KEYS, "START", "END", "LEAD_VARIANTS", "LEAD_P")


def union_loci(loci: DataFrame, merge_gap_bp: int = 0, mode: str = "interval", bin_bp: int = 1_000_000) -> DataFrame:
    """Loci of all populations merged into population ``combined``.

    ``interval`` merges the real intervals.  ``midpoint`` first shrinks each
    locus to its midpoint, which gives zero-width combined loci.
    """
    if mode == "interval":
        bounds = {"START": F.col("START"), "END": F.col("END")}
    elif mode == "midpoint":
        middle = F.floor((F.col("START") + F.col("END")) / 2)
        bounds = {"START": F.greatest(F.lit(1), middle), "END": middle}
    else:
        raise ValueError(f"unknown mode {mode!r}")
    pooled = loci.select(
        F.lit("combined").alias("POPULATION"), "CHR", *[expr.cast("bigint").alias(n) for n, expr in bounds.items()],
        "LEAD_P", F.col("N_LEADS").alias("_LEADS"),
    )
    return _merged(pooled, merge_gap_bp, bin_bp)[0]
