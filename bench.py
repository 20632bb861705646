"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from variantloom.queries import registry  # noqa: E402
from variantloom.session import ensure_checkpoint_dir, local_session  # noqa: E402

HEADLINE = (
    "derive_stats", "harmonised", "qc_summary", "dedupe_best_p", "meta_ivw", "meta_heterogeneity", "loci_merge", "loci_union",
    "ld_pairs", "ld_clump", "panel_match", "region_join", "abf_single_effect", "credible_set", "finemap_sets", "consensus_pip",
    "prioritised", "best_consequence", "qtl_summary", "splice_full_outer", "coloc_pairs", "cross_population", "priority_score",
    "study_population", "trait_match", "study_select",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, "variantloom-bench")
    ensure_checkpoint_dir(spark)
    registry.OPERATORS["dedupe_best_p"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds: dict[str, float] = {}
    for name in names:
        best = float("inf")
        for _ in range(repeats):
            start = time.perf_counter()
            registry.OPERATORS[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - start)
        seconds[name] = round(best, 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, best of %d runs, total" % repeats,
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
                "spark": spark.version,
                "cpus": cpus,
                "shuffle_partitions": spark.conf.get("spark.sql.shuffle.partitions"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
