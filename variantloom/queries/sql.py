"""DuckDB counterparts of the views, written independently of the Spark code."""

from __future__ import annotations

from variantloom.functions import tails as T
from variantloom.operators.annotation import CLASS_ORDER, CONSEQUENCE_CLASSES
from variantloom.queries.views import REGION_CATEGORY, TERMS


def r6(expression: str, places: int = 6) -> str:
    """Rounded, without a negative zero."""
    return f"(round({expression}, {places}) + 0.0)"


def _poly(leading: float, numer, denom, x: str) -> str:
    top, bottom = f"{leading!r}::DOUBLE*{x}", x
    for n, d in zip(numer[:-1], denom[:-1], strict=True):
        top, bottom = f"(({top})+{n!r}::DOUBLE)*{x}", f"(({bottom})+{d!r}::DOUBLE)*{x}"
    return f"((({top})+{numer[-1]!r}::DOUBLE)/(({bottom})+{denom[-1]!r}::DOUBLE))"


def _ranges(t: str) -> tuple[str, str, str]:
    near = f"(1.0-({t})*{_poly(T.CODY_A[4], T.CODY_A[:4], T.CODY_B, f'(({t})*({t}))')})"
    middle = _poly(T.CODY_C[8], T.CODY_C[:8], T.CODY_D, f"({t})")
    y = f"(1.0/(({t})*({t})))"
    far = f"((1.0/sqrt(pi())-{y}*{_poly(T.CODY_P[5], T.CODY_P[:5], T.CODY_Q, y)})/({t}))"
    return near, middle, far


def two_sided_p(z: str) -> str:
    t = f"(abs({z})/sqrt(2.0::DOUBLE))"
    near, middle, far = _ranges(t)
    return (
        f"(CASE WHEN {t}<=0.46875 THEN {near} WHEN {t}<=4 THEN exp(-{t}*{t})*{middle} "
        f"WHEN {t} IS NOT NULL THEN exp(-{t}*{t})*{far} END)"
    )


def neg_log10_p(z: str) -> str:
    t = f"(abs({z})/sqrt(2.0::DOUBLE))"
    near, middle, far = _ranges(t)
    return (
        f"(-(CASE WHEN {t}<=0.46875 THEN ln({near}) WHEN {t}<=4 THEN -{t}*{t}+ln({middle}) "
        f"WHEN {t} IS NOT NULL THEN -{t}*{t}+ln({far}) END)/ln(10.0::DOUBLE))"
    )


def _strings(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


CATEGORY = (
    "CASE "
    + " ".join(
        f"WHEN list_has_any(string_split(coalesce(CONSEQUENCE, ''), '&'), {_strings(members)}) THEN '{name}'"
        for name, members in CONSEQUENCE_CLASSES.items()
    )
    + " ELSE 'OTHER' END"
)
RANK = f"(list_position({_strings(CLASS_ORDER)}, FUNCTIONAL_CATEGORY) - 1)"
_A1, _A2 = "substr('ACAGAC', CAST({v} % 6 + 1 AS INT), 1)", "substr('GTCTTG', CAST({v} % 6 + 1 AS INT), 1)"


def _score(step: int) -> str:
    return f"CAST(((p_size + {step}) % 51) / 51.0::DOUBLE AS VARCHAR)"


CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "assoc": (
        (),
        f"""SELECT *, 'study_' || POPULATION AS STUDY_ID, 1.0 / ((q*q)*(q*q)*((q*q)*(q*q))) AS P, N_CASES + N_CONTROLS AS N,
          4.0 / (1.0 / N_CASES + 1.0 / N_CONTROLS) AS N_EFF,
          CHR || ':' || POS || ':' || least(EA, NEA) || ':' || greatest(EA, NEA) AS VARIANT_ID
        FROM (SELECT *, 1.0::DOUBLE + (BETA / SE) * (BETA / SE) / 2.0 AS q FROM (
          SELECT CASE l_suppkey % 5 WHEN 0 THEN 'EUR' WHEN 1 THEN 'AFR' WHEN 2 THEN 'EAS' WHEN 3 THEN 'SAS' ELSE 'AMR' END AS POPULATION,
            CAST(l_partkey % 22 + 1 AS VARCHAR) AS CHR, CAST((l_partkey // 22) * 5000 + 10000 AS BIGINT) AS POS,
            'rs' || l_partkey AS RSID,
            CASE WHEN l_linenumber % 2 = 0 THEN {_A1.format(v='l_partkey')} ELSE {_A2.format(v='l_partkey')} END AS EA,
            CASE WHEN l_linenumber % 2 = 0 THEN {_A2.format(v='l_partkey')} ELSE {_A1.format(v='l_partkey')} END AS NEA,
            (l_quantity - 25.5::DOUBLE) / 100.0::DOUBLE AS BETA, 0.02::DOUBLE + l_discount / 2.0::DOUBLE AS SE,
            CASE WHEN l_linenumber <> 7 THEN 0.05::DOUBLE + l_tax * 5.0::DOUBLE END AS EAF,
            CASE WHEN l_linenumber <> 6 THEN CAST(l_orderkey % 5000 + 100 AS DOUBLE) END AS N_CASES,
            CASE WHEN l_linenumber <> 6 THEN CAST(l_orderkey % 9000 + 500 AS DOUBLE) END AS N_CONTROLS,
            l_returnflag, l_linestatus, l_linenumber, l_tax
          FROM lineitem))""",
    ),
    "best": (
        ("assoc",),
        """SELECT * FROM assoc QUALIFY row_number() OVER (PARTITION BY POPULATION, VARIANT_ID ORDER BY P, EA NULLS LAST,
          BETA NULLS LAST, SE NULLS LAST, EAF NULLS LAST, N NULLS LAST, N_CASES NULLS LAST, N_CONTROLS NULLS LAST) = 1""",
    ),
    "derived": (
        ("assoc",),
        f"""SELECT *, CASE WHEN l_linenumber = 4 THEN NLP_IN WHEN P > 1e-300 THEN -log10(P) ELSE {neg_log10_p('Z')} END AS NEG_LOG10_P
        FROM (SELECT * EXCLUDE (P_IN), coalesce(P_IN, pow(10.0::DOUBLE, -NLP_IN), {two_sided_p('Z')}) AS P
        FROM (SELECT *, BETA / SE AS Z FROM (
          SELECT POPULATION, CHR, POS, RSID, CASE WHEN l_tax >= 0.08 THEN 'N' ELSE EA END AS EA, NEA,
            CASE WHEN l_returnflag = 'R' THEN ln(exp(BETA)) ELSE BETA END AS BETA,
            CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F'
              THEN (ln(exp(BETA + 1.959963984540054::DOUBLE * SE)) - ln(exp(BETA - 1.959963984540054::DOUBLE * SE))) / (2 * 1.959963984540054::DOUBLE)
              ELSE SE END AS SE,
            CASE WHEN l_returnflag = 'R' THEN exp(BETA) END AS "OR", EAF, N, N_CASES, N_CONTROLS, N_EFF, l_linenumber,
            CASE WHEN l_linenumber NOT IN (3, 4) THEN P END AS P_IN,
            CASE WHEN l_linenumber = 4 THEN abs(BETA / SE) END AS NLP_IN
          FROM assoc)))""",
    ),
    "kept": (
        ("derived",),
        """SELECT *, CHR || ':' || POS || ':' || least(EA, NEA) || ':' || greatest(EA, NEA) AS VARIANT_ID FROM derived
          WHERE EA IN ('A','C','G','T') AND NEA IN ('A','C','G','T') AND EA <> NEA AND SE > 0 AND P BETWEEN 0 AND 1
            AND (EAF IS NULL OR EAF BETWEEN 0 AND 1) AND POS > 0""",
    ),
    "aligned": (
        ("best",),
        """SELECT * EXCLUDE (BETA, EAF), CASE WHEN EA <> A2 THEN -BETA ELSE BETA END AS BETA,
            CASE WHEN EA <> A2 THEN 1.0 - EAF ELSE EAF END AS EAF
          FROM (SELECT VARIANT_ID, CHR, POS, least(EA, NEA) AS A1, greatest(EA, NEA) AS A2, EA, BETA, SE, EAF, N, N_CASES,
            N_CONTROLS, RSID, POPULATION AS POP FROM best)""",
    ),
    "usable": (
        ("aligned",),
        """SELECT * FROM aligned WHERE NOT (A1 || A2 IN ('AT', 'TA', 'CG', 'GC')
            AND (EAF IS NULL OR least(EAF, 1.0 - EAF) > 0.4))""",
    ),
    "meta": (
        ("usable",),
        f"""SELECT *, {two_sided_p('Z')} AS P, {neg_log10_p('Z')} AS NEG_LOG10_P FROM (SELECT *, BETA / SE AS Z,
            CASE WHEN N_POPULATIONS > 1 THEN CASE WHEN Q > 0 THEN greatest(0.0, (Q - (N_POPULATIONS - 1)) / Q) ELSE 0.0 END END AS I2
          FROM (SELECT VARIANT_ID, min(CHR) AS CHR, min(POS) AS POS, min(A1) AS A1, min(A2) AS A2, min(RSID) AS RSID, count(*) AS N_POPULATIONS,
            string_agg(POP, ',' ORDER BY POP) AS POPULATIONS,
            sum(BETA / (SE * SE)) / sum(1 / (SE * SE)) AS BETA, sqrt(1 / sum(1 / (SE * SE))) AS SE,
            greatest(0.0, sum(BETA * BETA / (SE * SE)) - pow(sum(BETA / (SE * SE)), 2) / sum(1 / (SE * SE))) AS Q,
            sum(EAF / (SE * SE)) / sum(CASE WHEN EAF IS NOT NULL THEN 1 / (SE * SE) END) AS EAF,
            sum(N) AS N, sum(N_CASES) AS N_CASES, sum(N_CONTROLS) AS N_CONTROLS,
            max(CASE WHEN POP = 'AFR' THEN BETA END) AS BETA_AFR, max(CASE WHEN POP = 'AMR' THEN BETA END) AS BETA_AMR,
            max(CASE WHEN POP = 'EAS' THEN BETA END) AS BETA_EAS, max(CASE WHEN POP = 'EUR' THEN BETA END) AS BETA_EUR,
            max(CASE WHEN POP = 'SAS' THEN BETA END) AS BETA_SAS,
            max(CASE WHEN POP = 'AFR' THEN SE END) AS SE_AFR, max(CASE WHEN POP = 'AMR' THEN SE END) AS SE_AMR,
            max(CASE WHEN POP = 'EAS' THEN SE END) AS SE_EAS, max(CASE WHEN POP = 'EUR' THEN SE END) AS SE_EUR,
            max(CASE WHEN POP = 'SAS' THEN SE END) AS SE_SAS
          FROM usable GROUP BY VARIANT_ID))""",
    ),
    "panel": (
        (),
        f"""SELECT *, CHR || ':' || POS || ':' || REF || ':' || ALT AS ID FROM (
          SELECT p_partkey AS V, CAST(p_partkey % 22 + 1 AS VARCHAR) AS CHR, CAST((p_partkey // 22) * 5000 + 10000 AS BIGINT) AS POS,
            CASE WHEN p_size % 2 = 1 THEN {_A2.format(v='p_partkey')} ELSE {_A1.format(v='p_partkey')} END AS REF,
            CASE WHEN p_size % 2 = 1 THEN {_A1.format(v='p_partkey')} ELSE {_A2.format(v='p_partkey')} END AS ALT,
            p_size, p_retailprice, p_type, p_name, p_brand FROM part)""",
    ),
    "matched": (
        ("assoc", "panel"),
        """SELECT 'L' || CHR AS LOCUS_ID, POPULATION, ID AS VARIANT_ID, CHR, POS, REF, ALT, RSID, EA, NEA, BETA, SE, P, EAF, N, N_CASES,
            N_CONTROLS, N_EFF, CASE WHEN EA = REF THEN -BETA ELSE BETA END AS BETA_ALT,
            CASE WHEN EA = REF THEN -BETA / SE ELSE BETA / SE END AS Z, CASE WHEN EA = REF THEN 1.0 - EAF ELSE EAF END AS EAF_ALT,
            CASE WHEN EA = REF THEN 'EA=REF_FLIPPED' ELSE 'EA=ALT' END AS ORIENTATION
          FROM (SELECT a.*, p.ID, p.REF, p.ALT FROM assoc a JOIN panel p ON a.CHR = p.CHR AND a.POS = p.POS
              AND least(a.EA, a.NEA) = least(p.REF, p.ALT) AND greatest(a.EA, a.NEA) = greatest(p.REF, p.ALT))
          QUALIFY row_number() OVER (PARTITION BY POPULATION, ID ORDER BY P, EA NULLS LAST, BETA NULLS LAST, SE NULLS LAST,
            EAF NULLS LAST, N NULLS LAST, N_CASES NULLS LAST, N_CONTROLS NULLS LAST) = 1""",
    ),
    "finemapped": (
        ("matched",),
        """SELECT LOCUS_ID, POPULATION, VARIANT_ID, CHR, POS, REF, ALT, Z, W / sum(W) OVER (PARTITION BY LOCUS_ID, POPULATION) AS PIP FROM (
          SELECT *, exp(L - max(L) OVER (PARTITION BY LOCUS_ID, POPULATION)) AS W FROM (
            SELECT *, 0.5::DOUBLE * ((0.2::DOUBLE / 1.2::DOUBLE) * Z * Z - ln(1.2::DOUBLE)) AS L FROM matched))""",
    ),
    "consensus": (
        ("finemapped",),
        """SELECT VARIANT_ID, 1.0 - product(1.0 - PIP) AS CROSS_ANCESTRY_PIP FROM finemapped GROUP BY VARIANT_ID""",
    ),
    "prioritised": (
        ("finemapped",),
        """SELECT * FROM (SELECT * FROM finemapped QUALIFY PIP >= 0.01 OR PIP = max(PIP) OVER (PARTITION BY POPULATION, LOCUS_ID))
          QUALIFY row_number() OVER (PARTITION BY VARIANT_ID ORDER BY PIP DESC, POPULATION, LOCUS_ID) = 1""",
    ),
    "units": (
        ("panel",),
        """SELECT POPULATION, CHR, POS, VARIANT_ID, S, (coalesce(X, M) - M) / sqrt(sum(pow(coalesce(X, M) - M, 2)) OVER w) AS U FROM (
          SELECT *, avg(X) OVER (PARTITION BY POPULATION, VARIANT_ID) AS M FROM (
            SELECT p.CHR, p.POS, p.ID AS VARIANT_ID, S, ['EUR', 'AFR', 'EAS', 'SAS', 'AMR'][CAST((S - 1) // 13 + 1 AS INT)] AS POPULATION,
              CASE WHEN abs(CAST(E AS DOUBLE)) <= 0.35 THEN CAST(E AS DOUBLE) + 1.0 END AS X
            FROM (SELECT vec_id, unnest(embedding) AS E, generate_subscripts(embedding, 1) AS S FROM embeddings) e
            JOIN panel p ON e.vec_id = p.V))
          WINDOW w AS (PARTITION BY POPULATION, VARIANT_ID)""",
    ),
    "vectors": (
        ("units",),
        """SELECT POPULATION, CHR, POS, VARIANT_ID, list(U ORDER BY S) AS U FROM units GROUP BY ALL""",
    ),
    "correlations": (
        ("vectors",),
        """SELECT a.POPULATION, a.CHR, a.VARIANT_ID AS ID_A, b.VARIANT_ID AS ID_B, a.POS AS POS_A, b.POS AS POS_B, list_dot_product(a.U, b.U) AS R
          FROM vectors a JOIN vectors b ON a.POPULATION = b.POPULATION AND a.CHR = b.CHR AND a.VARIANT_ID <> b.VARIANT_ID""",
    ),
    "qtl": (
        ("panel",),
        """SELECT p.ID AS VARIANT_ID, event_type AS TISSUE, ['eQTL', 'sQTL', 'apaQTL'][CAST(event_id % 3 + 1 AS INT)] AS QTL_TYPE,
            'GENE' || (event_id % 40) AS GENE_ID, 'GENE' || (event_id % 40) AS GENE, 'GENE' || (event_id % 40) AS QTL_PHENOTYPE,
            CASE WHEN event_id % 17 <> 0 THEN value / (value + 100.0) END AS QTL_PIP
          FROM events JOIN panel p ON user_id = p.V""",
    ),
    "consequence": (
        ("panel",),
        f"""SELECT VARIANT_ID, CONSEQUENCE, GENE, {CATEGORY} AS FUNCTIONAL_CATEGORY FROM (
          SELECT ID AS VARIANT_ID, 'GENE' || ((V + K) % 40) AS GENE,
            CASE WHEN p_size % 3 = 0 THEN t[CAST((V + K * 7) % len(t) + 1 AS INT)] || '&' || t[CAST((V + K * 7 + 11) % len(t) + 1 AS INT)]
              ELSE t[CAST((V + K * 7) % len(t) + 1 AS INT)] END AS CONSEQUENCE
          FROM (SELECT *, {_strings(TERMS)} AS t FROM panel) CROSS JOIN range(3) AS k(K))""",
    ),
    "best_consequence": (
        ("consequence",),
        f"""SELECT * FROM consequence QUALIFY row_number() OVER (PARTITION BY VARIANT_ID ORDER BY {RANK}, CONSEQUENCE, GENE) = 1""",
    ),
    "spliceai": (
        ("panel",),
        f"""SELECT KEY AS VARIANT_ID, ALT AS ALLELE, 'GENE' || ((V + o) % 40) AS GENE, a AS DS_AG, NULL::DOUBLE AS DS_AL, b AS DS_DG, c AS DS_DL,
            greatest(a, b, c) AS SPLICEAI_MAX FROM (
          SELECT V, ALT, ID AS KEY, 0 AS o, {_score(0)}::DOUBLE AS a, {_score(9)}::DOUBLE AS b, {_score(20)}::DOUBLE AS c FROM panel WHERE p_type <> 'PROMO'
          UNION ALL
          SELECT V, ALT, ID, 3, {_score(5)}::DOUBLE, {_score(14)}::DOUBLE, {_score(25)}::DOUBLE FROM panel WHERE p_type <> 'PROMO')""",
    ),
    "pangolin": (
        ("panel",),
        """SELECT ID AS VARIANT_ID, 'GENE' || (V % 40) AS GENE, (p_retailprice % 100.0) / 100.0 AS PANGOLIN_GAIN,
            -((p_size % 7) / 10.0::DOUBLE) AS PANGOLIN_LOSS,
            greatest((p_retailprice % 100.0) / 100.0, (p_size % 7) / 10.0::DOUBLE) AS PANGOLIN_SCORE FROM panel WHERE p_type <> 'LARGE'
          UNION ALL
          SELECT ID, 'GENE' || (V % 40) || 'B', 0.01::DOUBLE, NULL, 0.01::DOUBLE FROM panel WHERE p_type <> 'LARGE'""",
    ),
    "splicing": (
        ("spliceai", "pangolin"),
        """SELECT coalesce(s.VARIANT_ID, p.VARIANT_ID) AS VARIANT_ID, SPLICEAI_MAX, PANGOLIN_SCORE, SGENES, PGENES
          FROM (SELECT VARIANT_ID, max(SPLICEAI_MAX) AS SPLICEAI_MAX, string_agg(DISTINCT GENE, ',' ORDER BY GENE) AS SGENES FROM spliceai GROUP BY 1) s
          FULL JOIN (SELECT VARIANT_ID, max(PANGOLIN_SCORE) AS PANGOLIN_SCORE, string_agg(DISTINCT GENE, ',' ORDER BY GENE) AS PGENES FROM pangolin GROUP BY 1) p
          ON s.VARIANT_ID = p.VARIANT_ID""",
    ),
    "overlap": (
        ("finemapped", "qtl", "consensus"),
        """SELECT f.LOCUS_ID, f.POPULATION, f.VARIANT_ID, f.PIP AS GWAS_PIP, c.CROSS_ANCESTRY_PIP, q.TISSUE, q.QTL_TYPE, q.GENE_ID, q.GENE,
            q.QTL_PHENOTYPE, q.QTL_PIP, f.PIP * q.QTL_PIP AS vCLPP
          FROM finemapped f LEFT JOIN consensus c USING (VARIANT_ID) JOIN qtl q USING (VARIANT_ID)""",
    ),
    "pairs": (
        ("overlap",),
        """SELECT LOCUS_ID, POPULATION, GENE, TISSUE, QTL_TYPE,
            CASE WHEN max(vCLPP) >= 1 THEN 1.0 ELSE coalesce(1.0 - product(1.0 - vCLPP), 0.0) END AS LCLPP, max(vCLPP) AS MAX_vCLPP,
            count(*) AS N_MATCHING_VARIANTS, count(*) FILTER (vCLPP IS NULL) AS N_NULL_PIP,
            arg_min(VARIANT_ID, {'s': -coalesce(vCLPP, -1.0), 'v': VARIANT_ID}) AS TOP_VARIANT
          FROM overlap GROUP BY ALL""",
    ),
    "comparison": (
        ("finemapped",),
        """SELECT *, (coalesce(AFR_PIP >= 0.1, false)::BIGINT + coalesce(AMR_PIP >= 0.1, false)::BIGINT + coalesce(EAS_PIP >= 0.1, false)::BIGINT
            + coalesce(EUR_PIP >= 0.1, false)::BIGINT + coalesce(SAS_PIP >= 0.1, false)::BIGINT) AS N_SUPPORTING_POPULATIONS,
            greatest(AFR_PIP, AMR_PIP, EAS_PIP, EUR_PIP, SAS_PIP) AS MAX_POPULATION_PIP,
            list_avg([AFR_PIP, AMR_PIP, EAS_PIP, EUR_PIP, SAS_PIP]) AS MEAN_POPULATION_PIP
          FROM (SELECT VARIANT_ID, max(PIP) FILTER (POPULATION = 'AFR') AS AFR_PIP, max(PIP) FILTER (POPULATION = 'AMR') AS AMR_PIP,
            max(PIP) FILTER (POPULATION = 'EAS') AS EAS_PIP, max(PIP) FILTER (POPULATION = 'EUR') AS EUR_PIP,
            max(PIP) FILTER (POPULATION = 'SAS') AS SAS_PIP FROM finemapped GROUP BY 1)""",
    ),
    "evidence": (
        ("finemapped", "consensus", "best_consequence", "qtl", "overlap", "pairs", "splicing", "comparison"),
        """SELECT f.LOCUS_ID, f.POPULATION, f.VARIANT_ID, f.PIP, c.CROSS_ANCESTRY_PIP, b.CONSEQUENCE, b.FUNCTIONAL_CATEGORY, b.GENE,
            q.TISSUE, q.QTL_TYPE, q.QTL_PIP, o.vCLPP, s.SPLICEAI_MAX, s.PANGOLIN_SCORE, p.LCLPP, m.N_SUPPORTING_POPULATIONS
          FROM finemapped f LEFT JOIN consensus c ON f.VARIANT_ID = c.VARIANT_ID
          LEFT JOIN best_consequence b ON f.VARIANT_ID = b.VARIANT_ID
          LEFT JOIN qtl q ON f.VARIANT_ID = q.VARIANT_ID AND b.GENE = q.GENE
          LEFT JOIN overlap o ON f.VARIANT_ID = o.VARIANT_ID AND f.LOCUS_ID = o.LOCUS_ID AND f.POPULATION = o.POPULATION AND b.GENE = o.GENE
            AND q.TISSUE = o.TISSUE AND q.QTL_TYPE = o.QTL_TYPE
          LEFT JOIN splicing s ON f.VARIANT_ID = s.VARIANT_ID
          LEFT JOIN pairs p ON f.LOCUS_ID = p.LOCUS_ID AND f.POPULATION = p.POPULATION AND b.GENE = p.GENE AND q.TISSUE = p.TISSUE
            AND q.QTL_TYPE = p.QTL_TYPE
          LEFT JOIN comparison m ON f.VARIANT_ID = m.VARIANT_ID""",
    ),
    "catalog": (
        (),
        """SELECT 'GCST' || lpad(CAST(k + 1 AS VARCHAR), 6, '0') AS study_accession,
            CASE WHEN k % 11 = 0 THEN seg || ' (females)' WHEN k % 7 = 0 THEN seg || ' disorder [adjusted]' ELSE seg END AS reported_trait,
            CASE WHEN k % 5 = 0 THEN [lower(c_mktsegment), lower(r_name)] ELSE [lower(c_mktsegment)] END AS labels,
            CASE WHEN k % 5 = 0 THEN ['EFO_' || length(c_mktsegment), 'EFO_' || length(r_name)] ELSE ['EFO_' || length(c_mktsegment)] END AS ids,
            CASE WHEN k % 23 = 0 THEN 'smoking' END AS background_traits, CASE WHEN k % 3 <> 0 THEN CAST(k AS VARCHAR) END AS pubmed_id,
            CASE WHEN k % 2 = 0 THEN 'BIO; ' || n_name END AS cohorts, k % 977 * 10 AS n_cases, k % 1999 * 10 AS n_controls,
            k % 29 = 0 AS gxe, c_acctbal >= 0 AS summary_stats_available, k, r_name, n_name
          FROM (SELECT c_custkey AS k, c_mktsegment, upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) AS seg, c_acctbal, n_name, r_name
            FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)""",
    ),
}
CTES["ancestry"] = (
    ("catalog",),
    """SELECT study_accession, RECORD, CATEGORY, N, COUNTRY FROM (
      SELECT study_accession, 0 AS RECORD, CASE WHEN k % 4 = 3 THEN 'NR' ELSE cat END AS CATEGORY, CASE WHEN k % 4 IN (0, 1) THEN k + 1000 END AS N,
        CASE WHEN k % 4 IN (0, 2) THEN n_name END AS COUNTRY FROM c
      UNION ALL SELECT study_accession, 1, 'East Asian', NULL, 'Japan' FROM c WHERE k % 4 = 0
      UNION ALL SELECT study_accession, 1, 'Martian', NULL, 'Base 1' FROM c WHERE k % 4 = 2)""".replace(
        "FROM c", "FROM (SELECT *, CASE r_name " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in REGION_CATEGORY.items()) + " END AS cat FROM catalog)"
    ),
)


def with_(*names: str) -> str:
    """``WITH`` clause holding the named views and everything they need."""
    order: list[str] = []

    def visit(name: str) -> None:
        for need in CTES[name][0]:
            visit(need)
        if name not in order:
            order.append(name)

    for name in names:
        visit(name)
    return "WITH " + ",\n".join(f"{name} AS ({CTES[name][1]})" for name in order) + "\n"
