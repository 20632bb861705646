"""Posterior inclusion probabilities and credible sets, all loci in one plan.

Rows are (LOCUS_ID, POPULATION, VARIANT_ID, Z).  A locus is never gathered into
one task: per-locus facts come from partial aggregates joined back, and the
only LD needed per effect is the lead variant's correlation row.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from variantloom.functions import statistics as S
from variantloom.operators.ld import both_ways, dot, min_abs_r
from variantloom.plans.ordered import prefix_scan
from variantloom.operators.region import locus_sample_size
from variantloom.session import checkpointed

LOCUS = ["LOCUS_ID", "POPULATION"]
PRIOR_VARIANCE = 0.2
COVERAGE = 0.95
BROADCAST_LEADS = 64 << 20  # bytes of lead vectors of all loci

# (LOCUS_ID, POPULATION, LEAD) -> (LOCUS_ID, POPULATION, VARIANT_ID, R)
LeadRows = Callable[[DataFrame], DataFrame]


def log_bayes_factor(z: Column, prior_variance: float = PRIOR_VARIANCE) -> Column:
    """0.5 (v / (1 + v) z^2 - ln(1 + v))."""
    shrink = prior_variance / (1.0 + prior_variance)
    return 0.5 * (shrink * z * z - F.log1p(F.lit(prior_variance)))


def single_effect_posterior(
    rows: DataFrame, keys: Sequence[str] = tuple(LOCUS), z: str = "Z", prior_variance: float = PRIOR_VARIANCE
) -> DataFrame:
    """ALPHA, the softmax of the log Bayes factor over each locus.

    The two per-locus sums are fixed and, when few enough, broadcast, so the
    rows themselves are not shuffled.  Give it a stored table: it is read three
    times.
    """
    keys = list(keys)
    scored = rows.withColumn("_L", log_bayes_factor(F.col(z), prior_variance))
    top = checkpointed(scored.groupBy(*keys).agg(F.max("_L").alias("_TOP")))
    weighted = scored.join(top, keys).withColumn("_W", F.exp(F.col("_L") - F.col("_TOP")))
    total = checkpointed(weighted.groupBy(*keys).agg(F.sum("_W").alias("_TOTAL")))
    return weighted.join(total, keys).withColumn("ALPHA", F.col("_W") / F.col("_TOTAL")).drop("_L", "_TOP", "_W", "_TOTAL")


def credible_members(
    alphas: DataFrame, keys: Sequence[str] = ("LOCUS_ID", "POPULATION", "EFFECT"), coverage: float = COVERAGE
) -> DataFrame:
    """Shortest prefix by descending posterior whose sum reaches the coverage."""
    order = [F.col("ALPHA").desc(), F.col("VARIANT_ID").asc()]
    ranked = prefix_scan(alphas, list(keys), order, {"_BEFORE": F.col("ALPHA")}, rank="CS_RANK")
    return ranked.filter(F.col("_BEFORE") < coverage).drop("_BEFORE")


def lead_rows_from_table(ld: DataFrame) -> LeadRows:
    """Correlations from a long (POPULATION, ID_A, ID_B, R) table of unordered pairs."""
    table = both_ways(ld)

    def rows(leads: DataFrame) -> DataFrame:
        return leads.withColumnRenamed("LEAD", "ID_A").join(table, ["POPULATION", "ID_A"]).select(
            *LOCUS, F.col("ID_B").alias("VARIANT_ID"), "R"
        )

    return rows


def lead_rows_from_units(rows: DataFrame, units: DataFrame) -> LeadRows:
    """Correlations from unit dosage vectors: one vector per locus is joined, not a matrix."""
    placed = checkpointed(rows.select(*LOCUS, "VARIANT_ID").join(units.select("POPULATION", "VARIANT_ID", "UNIT"), ["POPULATION", "VARIANT_ID"]))

    def lookup(leads: DataFrame) -> DataFrame:
        lead_units = leads.join(
            units.select("POPULATION", F.col("VARIANT_ID").alias("LEAD"), F.col("UNIT").alias("LEAD_UNIT")), ["POPULATION", "LEAD"]
        )
        return placed.join(lead_units.select(*LOCUS, "LEAD_UNIT"), LOCUS).select(
            *LOCUS, "VARIANT_ID", dot("UNIT", "LEAD_UNIT").alias("R")
        )

    return lookup


def multi_effect_posteriors(
    rows: DataFrame, lead_rows: LeadRows, max_effects: int = 10, prior_variance: float = PRIOR_VARIANCE
) -> tuple[DataFrame, DataFrame]:
    """Effects taken one after another on LD residuals; every locus advances together.

    Returns (alphas, effects): alphas has LOCUS_ID, POPULATION, VARIANT_ID, Z,
    EFFECT and ALPHA; effects has the lead of each effect and WEAK, set when its
    absolute residual is below one, which ends that locus.  A round is one
    aggregate and two joins followed by a checkpoint; there are at most
    ``max_effects`` rounds.
    """
    state = checkpointed(
        rows.select(*LOCUS, "VARIANT_ID", "Z").withColumns(
            {"_RES": F.col("Z").cast("double"), "_W": F.array().cast("array<double>"), "_OPEN": F.lit(True)}
        )
    )
    effects: DataFrame | None = None
    for effect in range(1, max_effects + 1):
        leads = state.filter("_OPEN").groupBy(*LOCUS).agg(
            F.min(F.struct((-F.abs("_RES")).alias("A"), F.col("VARIANT_ID"), F.col("_RES"))).alias("_LEAD"),
            F.count("*").alias("_M"),
        )
        leads = checkpointed(
            leads.select(
                *LOCUS, F.lit(effect).alias("EFFECT"), F.col("_LEAD.VARIANT_ID").alias("LEAD"),
                F.col("_LEAD._RES").alias("LEAD_RESIDUAL"), "_M",
            ).withColumn("WEAK", F.abs("LEAD_RESIDUAL") < 1.0)
        )
        effects = leads if effects is None else effects.unionByName(leads)
        going = leads.filter(~F.col("WEAK") & (F.lit(effect) < F.col("_M"))) if effect < max_effects else None
        last = going is None or going.isEmpty()
        weight = F.exp(
            log_bayes_factor(F.col("_RES"), prior_variance) - log_bayes_factor(F.col("LEAD_RESIDUAL"), prior_variance)
        )
        state = state.join(leads.select(*LOCUS, "LEAD", "LEAD_RESIDUAL", "WEAK", "_M"), LOCUS, "left").withColumn(
            "_W", F.when(F.col("_OPEN"), F.array_append("_W", weight)).otherwise(F.col("_W"))
        )
        if last:
            break
        correlated = lead_rows(going.select(*LOCUS, "LEAD"))
        r = F.when(F.col("VARIANT_ID") == F.col("LEAD"), 1.0).otherwise(F.coalesce("R", F.lit(0.0)))
        still = F.col("_OPEN") & ~F.col("WEAK") & (F.lit(effect) < F.col("_M"))
        state = checkpointed(
            state.join(correlated, [*LOCUS, "VARIANT_ID"], "left")
            .withColumn("_STILL", F.coalesce(still, F.lit(False)))
            .select(
                *LOCUS, "VARIANT_ID", "Z",
                F.when(F.col("_STILL"), F.col("_RES") - r * F.col("LEAD_RESIDUAL")).otherwise(F.col("_RES")).alias("_RES"),
                "_W", F.col("_STILL").alias("_OPEN"),
            )
        )
    state = checkpointed(state.select(*LOCUS, "VARIANT_ID", "Z", "_W"))
    weights = state.select(*LOCUS, "VARIANT_ID", "Z", F.posexplode("_W").alias("_E", "_WEIGHT")).withColumn("EFFECT", F.col("_E") + 1)
    totals = weights.groupBy(*LOCUS, "EFFECT").agg(F.sum("_WEIGHT").alias("_TOTAL"))
    alphas = weights.join(totals, [*LOCUS, "EFFECT"]).select(
        *LOCUS, "VARIANT_ID", "Z", "EFFECT", (F.col("_WEIGHT") / F.col("_TOTAL")).alias("ALPHA")
    )
    return alphas, effects.select(*LOCUS, "EFFECT", "LEAD", "LEAD_RESIDUAL", "WEAK")


def _correlation(lead: Column) -> Column:
    """r of a row with a lead; a variant without an LD vector has none with any other."""
    return F.when(F.col("VARIANT_ID") == lead["LEAD"], 1.0).otherwise(F.coalesce(dot("UNIT", lead["UNIT"]), F.lit(0.0)))


def multi_effect_from_units(
    rows: DataFrame, units: DataFrame, max_effects: int = 10, prior_variance: float = PRIOR_VARIANCE
) -> tuple[DataFrame, DataFrame]:
    """:func:`multi_effect_posteriors` from unit dosage vectors, which stay where they are.

    Rows and their vectors are stored once and never written or moved again.  What a
    round knows is one row a locus, the leads taken so far with their vectors.  It is
    broadcast to the rows; each follows its residual through those leads by row-local dot
    products, and one partial aggregate takes the next lead and hands the chain on: a
    round is one small shuffle.  Where loci times effects times samples is more than
    ``BROADCAST_LEADS``, the general rounds join one vector a locus instead.
    """
    told = rows.select(*LOCUS, "VARIANT_ID", F.col("Z").cast("double").alias("Z"))
    placed = checkpointed(told.join(units.select("POPULATION", "VARIANT_ID", "UNIT"), ["POPULATION", "VARIANT_ID"], "left"))
    facts = placed.agg(F.count_distinct(*LOCUS).alias("n"), F.max(F.size("UNIT")).alias("s")).first()
    if facts["n"] * max_effects * max(facts["s"] or 0, 16) * 8 > BROADCAST_LEADS:
        return multi_effect_posteriors(rows, lead_rows_from_units(rows, units), max_effects, prior_variance)
    kind = "array<struct<EFFECT:int,LEAD:string,LEAD_RESIDUAL:double,WEAK:boolean,UNIT:array<double>>>"
    chain = placed.select(*LOCUS).distinct().select(*LOCUS, F.array().cast(kind).alias("_LEADS"))
    residual = F.aggregate("_LEADS", F.col("Z"), lambda res, lead: res - _correlation(lead) * lead["LEAD_RESIDUAL"])
    done: list[DataFrame] = []
    for effect in range(1, max_effects + 1):
        best = placed.join(F.broadcast(chain), LOCUS).select(*LOCUS, "_LEADS", residual.alias("_RES"), "VARIANT_ID", "UNIT").groupBy(*LOCUS).agg(
            F.min(F.struct((-F.abs("_RES")).alias("A"), F.col("VARIANT_ID"), F.col("_RES"), F.col("UNIT"))).alias("_L"),
            F.first("_LEADS").alias("_LEADS"), F.count("*").alias("_M"),
        )
        weak = F.abs("_L._RES") < 1.0
        new = F.struct(F.lit(effect).alias("EFFECT"), F.col("_L.VARIANT_ID").alias("LEAD"), F.col("_L._RES").alias("LEAD_RESIDUAL"), weak.alias("WEAK"), F.col("_L.UNIT").alias("UNIT"))
        taken = checkpointed(best.select(*LOCUS, F.array_append("_LEADS", new).alias("_LEADS"), (~weak & (F.lit(effect) < F.col("_M"))).alias("_OPEN")))
        if effect == max_effects:
            done.append(taken.drop("_OPEN"))
            break
        done.append(taken.filter("not _OPEN").drop("_OPEN"))
        chain = taken.filter("_OPEN").drop("_OPEN")
        if chain.isEmpty():
            break

    def follow(state: Column, lead: Column) -> Column:
        weight = F.exp(log_bayes_factor(state["res"], prior_variance) - log_bayes_factor(lead["LEAD_RESIDUAL"], prior_variance))
        return F.struct(
            (state["res"] - _correlation(lead) * lead["LEAD_RESIDUAL"]).alias("res"),
            F.array_append(state["w"], F.struct(lead["EFFECT"].alias("EFFECT"), weight.alias("WEIGHT"))).alias("w"),
        )

    chains = reduce(DataFrame.unionByName, done)
    start = F.struct(F.col("Z").alias("res"), F.array().cast("array<struct<EFFECT:int,WEIGHT:double>>").alias("w"))
    weighed = placed.join(F.broadcast(chains), LOCUS).select(
        *LOCUS, "VARIANT_ID", "Z", F.explode(F.aggregate("_LEADS", start, follow, lambda state: state["w"])).alias("_E")
    )
    weights = checkpointed(weighed.select(*LOCUS, "VARIANT_ID", "Z", F.col("_E.EFFECT").alias("EFFECT"), F.col("_E.WEIGHT").alias("_WEIGHT")))
    totals = weights.groupBy(*LOCUS, "EFFECT").agg(F.sum("_WEIGHT").alias("_TOTAL"))
    alphas = weights.join(F.broadcast(totals), [*LOCUS, "EFFECT"]).select(*LOCUS, "VARIANT_ID", "Z", "EFFECT", (F.col("_WEIGHT") / F.col("_TOTAL")).alias("ALPHA"))
    effects = chains.select(*LOCUS, F.inline("_LEADS"))
    return alphas, effects.select(*LOCUS, "EFFECT", "LEAD", "LEAD_RESIDUAL", "WEAK")


def inclusion_probability(alphas: DataFrame) -> DataFrame:
    """PIP = 1 - prod(1 - alpha) over effects."""
    return alphas.groupBy(*LOCUS, "VARIANT_ID").agg(
        F.max("Z").alias("Z"), (1.0 - F.product(1.0 - F.col("ALPHA"))).alias("PIP")
    )


def purity_from_table(members: DataFrame, ld: DataFrame) -> DataFrame:
    """Smallest |r| inside each set from a long LD table; a missing pair counts as zero."""
    table = both_ways(ld).filter(F.col("ID_A") < F.col("ID_B"))
    a = members.select("SET_ID", "POPULATION", F.col("VARIANT_ID").alias("ID_A"))
    b = members.select("SET_ID", F.col("VARIANT_ID").alias("ID_B"))
    found = (
        a.join(table, ["POPULATION", "ID_A"]).join(b, ["SET_ID", "ID_B"])
        .groupBy("SET_ID").agg(F.min(F.abs("R")).alias("_LOW"), F.count("*").alias("_PAIRS"))
    )
    size = members.groupBy("SET_ID").agg(F.count("*").alias("_K"))
    expected = F.col("_K") * (F.col("_K") - 1) / 2
    return size.join(found, "SET_ID", "left").select(
        "SET_ID",
        F.when(F.col("_K") < 2, 1.0).when(F.coalesce("_PAIRS", F.lit(0)) < expected, 0.0).otherwise(F.col("_LOW")).alias("MIN_ABS_R"),
    )


def credible_sets(
    members: DataFrame, purity: DataFrame, effects: DataFrame | None = None, min_purity: float = 0.5
) -> DataFrame:
    """One row per set: achieved coverage, purity and size; weak and impure sets are marked, not hidden."""
    sets = members.groupBy(*LOCUS, "EFFECT", "SET_ID").agg(
        F.sum("ALPHA").alias("COVERAGE"), F.count("*").alias("N_VARIANTS")
    )
    out = sets.join(purity, "SET_ID", "left").select(
        *LOCUS, F.concat("LOCUS_ID", F.lit(":CS"), F.col("EFFECT").cast("string")).alias("CS_ID"), "EFFECT", "COVERAGE",
        F.coalesce("MIN_ABS_R", F.lit(1.0)).alias("PURITY_MIN_ABS_COR"), "N_VARIANTS",
    ).withColumn("LOW_PURITY", F.col("PURITY_MIN_ABS_COR") < min_purity)
    if effects is not None:
        out = out.join(effects.select(*LOCUS, "EFFECT", "WEAK"), [*LOCUS, "EFFECT"], "left")
    return out


def with_set_ids(members: DataFrame) -> DataFrame:
    """A key per set; one locus id may occur in several populations."""
    return members.withColumn("SET_ID", F.concat_ws("|", "POPULATION", "LOCUS_ID", F.col("EFFECT").cast("string")))


def membership(members: DataFrame) -> DataFrame:
    """CREDIBLE_SETS per variant; at most one entry per effect."""
    cs = F.concat("LOCUS_ID", F.lit(":CS"), F.col("EFFECT").cast("string"))
    return members.groupBy(*LOCUS, "VARIANT_ID").agg(
        F.transform(F.array_sort(F.collect_list(F.struct(F.col("EFFECT").alias("E"), cs.alias("C")))), lambda s: s["C"]).alias("CREDIBLE_SETS")
    )


def finemap(
    rows: DataFrame,
    posteriors: Callable[..., tuple[DataFrame, DataFrame]],
    purity_of: Callable[[DataFrame], DataFrame],
    coverage: float = COVERAGE,
    max_effects: int = 10,
    prior_variance: float = PRIOR_VARIANCE,
    min_purity: float = 0.5,
) -> dict[str, DataFrame]:
    """Variants with PIP and set membership, sets, long members, per-locus summary, diagnostics."""
    alphas, effects = posteriors(rows, max_effects=max_effects, prior_variance=prior_variance)
    alphas = checkpointed(alphas)
    members = checkpointed(with_set_ids(credible_members(alphas, coverage=coverage)))
    sets = credible_sets(members, purity_of(members), effects, min_purity)
    extra = [c for c in rows.columns if c not in {*LOCUS, "VARIANT_ID", "Z"}]
    variants = inclusion_probability(alphas).join(membership(members), [*LOCUS, "VARIANT_ID"], "left").withColumn(
        "CREDIBLE_SETS", F.coalesce("CREDIBLE_SETS", F.array().cast("array<string>"))
    )
    if extra:
        variants = variants.join(rows.select(*LOCUS, "VARIANT_ID", *extra), [*LOCUS, "VARIANT_ID"], "left")
    summary = locus_summary(variants, sets)
    diagnostics = effects.groupBy(*LOCUS).agg(F.max("EFFECT").alias("N_ROUNDS"), F.max("WEAK").alias("STOPPED_WEAK")).withColumn(
        "ENGINE", F.lit("sequential_abf")
    )
    return {"variants": variants, "credible_sets": sets, "members": members, "summary": summary, "diagnostics": diagnostics}


def finemap_from_table(rows: DataFrame, ld: DataFrame, **options) -> dict[str, DataFrame]:
    posteriors = lambda rows, **more: multi_effect_posteriors(rows, lead_rows_from_table(ld), **more)
    return finemap(rows, posteriors, lambda members: purity_from_table(members, ld), **options)


def finemap_from_units(rows: DataFrame, units: DataFrame, **options) -> dict[str, DataFrame]:
    posteriors = lambda rows, **more: multi_effect_from_units(rows, units, **more)
    return finemap(rows, posteriors, lambda members: min_abs_r(members, units), **options)


def locus_summary(variants: DataFrame, sets: DataFrame) -> DataFrame:
    counts = sets.groupBy(*LOCUS).agg(F.max("EFFECT").alias("N_EFFECTS"), F.count("*").alias("N_CREDIBLE_SETS"))
    return (
        variants.groupBy(*LOCUS).agg(F.count("*").alias("N_VARIANTS"), F.max("PIP").alias("MAX_PIP"))
        .join(counts, LOCUS, "left").withColumn("STATUS", F.lit("OK"))
    )


def ld_coverage(rows: DataFrame, units: DataFrame, keys: Sequence[str] = LOCUS) -> DataFrame:
    """Per locus: matched variants, those with an LD vector in their population, and those lost without one."""
    kept = units.select("POPULATION", "VARIANT_ID").distinct().withColumn("_KEPT", F.lit(1))
    counts = rows.join(kept, ["POPULATION", "VARIANT_ID"], "left").groupBy(*keys).agg(
        F.count("*").alias("N_MATCHED"), F.count("_KEPT").alias("N_WITH_LD")
    )
    return counts.withColumn("N_LOST", F.col("N_MATCHED") - F.col("N_WITH_LD"))


def validate_inputs(rows: DataFrame, ld: DataFrame | None = None, tolerance: float = 1e-7) -> DataFrame:
    """Loci whose Z is not finite, and populations whose LD is not finite or symmetric."""
    bad_z = rows.groupBy(*LOCUS).agg(F.sum((~S.is_finite("Z")).cast("bigint")).alias("N_BAD")).filter("N_BAD > 0")
    problems = bad_z.select(*LOCUS, F.lit("fine-mapping inputs must be finite").alias("REASON"))
    if ld is not None:
        directed = ld.select("POPULATION", F.least("ID_A", "ID_B").alias("A"), F.greatest("ID_A", "ID_B").alias("B"), "R")
        pairs = directed.groupBy("POPULATION", "A", "B").agg(
            (F.max("R") - F.min("R")).alias("D"), F.max((~S.is_finite("R")).cast("int")).alias("BAD")
        )
        faults = pairs.groupBy("POPULATION").agg(F.max("D").alias("D"), F.max("BAD").alias("BAD"))
        problems = problems.unionByName(
            faults.filter((F.col("BAD") > 0) | (F.col("D") > tolerance)).select(
                F.lit(None).cast("string").alias("LOCUS_ID"), "POPULATION",
                F.when(F.col("BAD") > 0, "fine-mapping inputs must be finite").otherwise("LD matrix is not symmetric").alias("REASON"),
            )
        )
    return problems


def consensus_pip(finemapped: DataFrame) -> DataFrame:
    """1 - prod(1 - PIP) over populations and loci of a variant."""
    return finemapped.groupBy("VARIANT_ID").agg((1.0 - F.product(1.0 - F.col("PIP"))).alias("CROSS_ANCESTRY_PIP"))


def shared_variants(rows: DataFrame, n_populations: int) -> DataFrame:
    """Variants of a locus present in every population."""
    return (
        rows.groupBy("LOCUS_ID", "VARIANT_ID").agg(F.count_distinct("POPULATION").alias("N_POPULATIONS"))
        .filter(F.col("N_POPULATIONS") == n_populations)
    )


def multi_population_inputs(
    rows: DataFrame, populations: Sequence[str], min_variants: int = 10, kept_by_ld: DataFrame | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Inputs of a joint analysis: (aligned rows, sizes per population, failures).

    Every population must have the same variants at a locus and its own LD;
    ``kept_by_ld`` (POPULATION, VARIANT_ID) says which variants its LD kept.
    """
    if len(set(populations)) < 2:
        raise ValueError("multi-population fine-mapping needs at least two populations")
    chosen = rows.filter(F.col("POPULATION").isin(*populations))
    shared = shared_variants(chosen, len(set(populations)))
    counts = chosen.select("LOCUS_ID").distinct().join(
        shared.groupBy("LOCUS_ID").agg(F.count("*").alias("N_SHARED")), "LOCUS_ID", "left"
    )
    n = F.coalesce("N_SHARED", F.lit(0))
    failures = counts.filter(n < min_variants).select(
        "LOCUS_ID", F.lit(None).cast("string").alias("POPULATION"),
        F.concat(F.lit("only "), n.cast("string"), F.lit(" variants occur in every population")).alias("REASON"),
    )
    aligned = chosen.join(shared.select("LOCUS_ID", "VARIANT_ID"), ["LOCUS_ID", "VARIANT_ID"], "left_semi").join(
        failures.select("LOCUS_ID"), "LOCUS_ID", "left_anti"
    )
    if kept_by_ld is not None:
        lost = aligned.join(kept_by_ld, ["POPULATION", "VARIANT_ID"], "left_anti").select("LOCUS_ID", "POPULATION").distinct()
        failures = failures.unionByName(
            lost.select("LOCUS_ID", "POPULATION", F.concat("POPULATION", F.lit(" lacks LD for variants that the other populations have")).alias("REASON"))
        )
        aligned = aligned.join(lost.select("LOCUS_ID").distinct(), "LOCUS_ID", "left_anti")
    sizes = locus_sample_size(aligned) if {"N", "N_EFF"} <= set(aligned.columns) else aligned.select(*LOCUS).distinct()
    return aligned, sizes, failures


def with_ld_order(aligned: DataFrame) -> DataFrame:
    """``aligned`` with LD_ORDER, the place of a variant among those of its locus, the same in every population.

    A place is a rank over range partitions, so a locus of any size spans tasks; it is a
    column, so that no later step has to rely on the order of rows.
    """
    variants = aligned.select("LOCUS_ID", "VARIANT_ID").distinct()
    ranked = prefix_scan(variants, ["LOCUS_ID"], [F.col("VARIANT_ID").asc()], rank="_R")
    return aligned.join(ranked.select("LOCUS_ID", "VARIANT_ID", (F.col("_R") - 1).alias("LD_ORDER")), ["LOCUS_ID", "VARIANT_ID"])
