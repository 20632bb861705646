"""DuckDB SQL that gives the rows of the registered queries by a plainer way."""

from __future__ import annotations

from variantloom.llm.license_scan import RULES, SENTENCES, normal_text

OP9_QUALITY_RULES = """
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^ \\t\\n\\x0B\\f\\r]')) AS lines
  FROM documents
), grams AS (
  SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS g
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w)
), again AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM grams) WHERE n > 1
), covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM again) GROUP BY doc_id
), m AS (
  SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(len(lines) AS BIGINT) AS n_lines,
         CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
         CAST(len(list_filter(words, lambda x: lower(x) IN (
           'the','of','and','to','in','is','that','for','it','with','as','was','on','be','by','this','are','from','or',
           'de','la','que','el','en','y','los','se','las','un','por','con','para','una','su','no','es',
           'le','les','et','des','est','une','du','dans','qui','pour','pas','sur','avec','ce','il','au',
           'der','die','und','das','den','von','zu','mit','sich','auf','ist','im','dem','nicht','ein','eine','als','für'))) AS BIGINT) AS n_stop_words,
         CAST(length(regexp_replace(text, '[^A-Z]', '', 'g')) AS BIGINT) AS n_upper
  FROM w LEFT JOIN covered ON w.doc_id = covered.doc_id
), f AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    list_filter([
      CASE WHEN n_words < 50 THEN 'too_short' END,
      CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 'repeated_windows' END,
      CASE WHEN word_chars < 2 * n_words OR word_chars > 20 * n_words THEN 'word_length' END,
      CASE WHEN 100 * n_symbols > 15 * n_words THEN 'symbols' END,
      CASE WHEN 100 * n_stop_words < 2 * n_words THEN 'few_stop_words' END,
      CASE WHEN 10 * n_upper > 4 * word_chars THEN 'upper_case' END,
      CASE WHEN 2 * n_dup_lines > n_lines THEN 'repeated_lines' END], lambda x: x IS NOT NULL) AS failed
  FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_stop_words, n_upper, base_failed,
       len(failed) = 0 AS kept, array_to_string(failed, ',') AS failed_rules
FROM f
"""


# Variants are written out as words here, not hashed, and every pair is compared.
OP3_LINE_DEDUP = """
WITH raw AS (
  SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i FROM documents
), lines AS (
  SELECT doc_id, i, w, array_to_string(w, ' ') AS norm FROM (
    SELECT doc_id, i, list_filter(regexp_split_to_array(line, '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS w FROM raw)
  WHERE len(w) > 0
), first_of AS (
  SELECT norm, min(row(doc_id, i)) AS ord, any_value(w) AS w FROM lines GROUP BY norm
), long_lines AS (SELECT * FROM first_of WHERE len(w) >= 8),
cut AS (
  SELECT ord, p, array_to_string(w[1:p - 1] || w[p + 1:], ' ') AS v FROM (SELECT ord, w, unnest(range(1, len(w) + 1)) AS p FROM long_lines)
), near AS (
  SELECT a.ord FROM cut a JOIN cut b ON a.v = b.v AND a.p = b.p AND b.ord < a.ord
  UNION SELECT a.ord FROM cut a JOIN long_lines b ON a.v = b.norm AND b.ord < a.ord
  UNION SELECT a.ord FROM long_lines a JOIN cut b ON a.norm = b.v AND b.ord < a.ord
), kept AS (SELECT ord FROM first_of WHERE ord NOT IN (SELECT ord FROM near)),
flagged AS (
  SELECT raw.doc_id, raw.i, raw.line, lines.norm IS NOT NULL AS has_word, kept.ord IS NOT NULL AS stays
  FROM raw LEFT JOIN lines ON raw.doc_id = lines.doc_id AND raw.i = lines.i LEFT JOIN kept ON kept.ord = row(raw.doc_id, raw.i)
)
SELECT doc_id, CAST(count(*) FILTER (has_word) AS BIGINT) AS n_lines, CAST(count(*) FILTER (has_word AND NOT stays) AS BIGINT) AS n_removed,
       coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (stays OR NOT has_word), '') AS text
FROM flagged GROUP BY doc_id
UNION ALL SELECT doc_id, 0, 0, NULL FROM documents WHERE text IS NULL
"""

# Eleven of thirteen aligned words leave four in a row unchanged: those find the shifts to count along.
OP5_DECONTAMINATION = """
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), ',.;:!?"''()[]{}', ''), '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS w FROM documents
), b AS (
  SELECT item_id, list_filter(regexp_split_to_array(translate(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), ',.;:!?"''()[]{}', ''), '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS w FROM benchmark
), dg AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 2)) AS i FROM d)),
bg AS (SELECT item_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] AS g FROM (SELECT item_id, w, unnest(range(1, len(w) - 2)) AS i FROM b)),
shifts AS (SELECT DISTINCT doc_id, item_id, dg.i - bg.i AS shift FROM dg JOIN bg ON dg.g = bg.g),
wins AS (
  SELECT doc_id, item_id, shift, d.w AS dw, b.w AS bw, unnest(range(1, greatest(len(b.w) - 11, 2))) AS s FROM shifts JOIN d USING (doc_id) JOIN b USING (item_id)
), counted AS (
  SELECT doc_id, item_id, shift, least(13, len(bw)) AS size,
         list_sum(list_transform(range(s, s + least(13, len(bw))), lambda j: CASE WHEN j + shift >= 1 AND j <= len(bw) AND dw[j + shift] = bw[j] THEN 1 ELSE 0 END)) AS n
  FROM wins
), good AS (
  SELECT doc_id, item_id, shift, max(n) AS n FROM counted WHERE n >= CASE WHEN size = 13 THEN 11 ELSE size END AND size >= 5 GROUP BY doc_id, item_id, shift
)
SELECT doc_id, item_id, CAST(max(n) AS BIGINT) AS best_words, CAST(count(*) AS BIGINT) AS n_places FROM good GROUP BY doc_id, item_id
"""

# All pairs that share a shingle are counted.
OP7_NGRAM_JACCARD = """
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS w FROM documents
), sh AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM d WHERE len(w) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o FROM sh a JOIN sh b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM pairs JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * o >= 85 * (p.n + q.n - o)),
reach AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, least(d.doc_id, coalesce(m.low, d.doc_id)) AS component_id
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN (SELECT x, min(y) AS low FROM reach GROUP BY x) m ON m.x = d.doc_id
"""


def op1_license_scan() -> str:
    """The two licence tables are parameters; the matching is written out by joins and windows."""
    known = ", ".join(f"('{name}', '{norm}')" for norm, name in {normal_text(s): n for n, s in SENTENCES}.items())
    rewritten = "marks"
    for name, sequence in RULES:
        rewritten = f"replace({rewritten}, '{''.join(f'<{x}>' for x in sequence)}', '{{{name}}}')"
    return f"""
WITH known(name, norm) AS (VALUES {known}),
seg AS (
  SELECT doc_id, list_filter(list_transform(
    string_split(regexp_replace(coalesce(text, ''), '([.!?:;])[ \\t]+', '\\1' || chr(10), 'g'), chr(10)),
    lambda x: trim(replace(regexp_replace(lower(x), '[^a-z0-9]+', ' ', 'g'), 'licence', 'license'))), lambda x: x <> '') AS s
  FROM documents
), pos AS (SELECT doc_id, s, unnest(range(1, len(s) + 1)) AS i FROM seg),
cand AS (
  SELECT doc_id, i, k, array_to_string(s[i:i + k - 1], ' ') AS norm
  FROM pos, (SELECT unnest(range(1, 7)) AS k) WHERE i + k - 1 <= len(s)
), best AS (SELECT doc_id, i, max(k) AS k, arg_max(name, k) AS name FROM cand JOIN known USING (norm) GROUP BY doc_id, i),
marked AS (
  SELECT pos.doc_id, pos.i, name,
         max(pos.i + best.k) OVER (PARTITION BY pos.doc_id ORDER BY pos.i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach
  FROM pos LEFT JOIN best ON pos.doc_id = best.doc_id AND pos.i = best.i
), lines AS (
  SELECT doc_id, string_agg(CASE WHEN coalesce(reach, 0) > i THEN '' WHEN name IS NULL THEN '|' ELSE '<' || name || '>' END, '' ORDER BY i) AS marks
  FROM marked GROUP BY doc_id
), done AS (SELECT doc_id, marks, {rewritten} AS out FROM lines)
SELECT d.doc_id,
       CAST(coalesce(len(regexp_extract_all(marks, '<([^>]*)>', 1)), 0) AS BIGINT) AS n_sentences,
       coalesce(array_to_string(regexp_extract_all(marks, '<([^>]*)>', 1), ','), '') AS sentences,
       coalesce((SELECT string_agg(x, ',' ORDER BY p) FROM (
          SELECT x, min(p) AS p FROM (SELECT unnest(regexp_extract_all(out, '\\{{([^}}]*)\\}}', 1)) AS x, generate_subscripts(regexp_extract_all(out, '\\{{([^}}]*)\\}}', 1), 1) AS p) GROUP BY x)), '') AS licenses,
       coalesce(array_to_string(regexp_extract_all(out, '<([^>]*)>', 1), ','), '') AS unresolved
FROM documents d LEFT JOIN done ON d.doc_id = done.doc_id
"""


# Every path is spelled out as a list of turns, and every node is added to all its ancestors.
OP11_PREFIX_TRIE = """
WITH t AS (
  SELECT conv_id AS c, r, x, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(r) || ':' || r || x)) AS p
  FROM (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL)
), convs AS (
  SELECT c, c - c % 5 AS base, xor(list_reduce(
    list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(c AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT))),
    lambda crc, b: list_reduce([xor(crc, b), 0, 1, 2, 3, 4, 5, 6, 7], lambda y, i: xor(y // 2, CAST(3988292384 AS BIGINT) * (y % 2)))),
    CAST(4294967295 AS BIGINT)) % 9 AS h
  FROM (SELECT DISTINCT c FROM t)
), again AS (
  SELECT k.c, t.p, r, x FROM convs AS k JOIN t ON t.c = k.base AND t.p <= k.h
  UNION ALL SELECT k.c, t.p, r, x FROM convs AS k JOIN t ON t.c = k.c AND t.p > k.h
), paths AS (
  SELECT c, row_number() OVER w AS d, list({'r': r, 'x': x}) OVER w AS turns, strlen(x) AS bytes
  FROM again WINDOW w AS (PARTITION BY c ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
  UNION ALL SELECT c, 0, [], 0 FROM convs
), nodes AS (
  SELECT d, turns, min(c) AS m, count(*) AS n, (count(*) - 1) * any_value(bytes) AS saved FROM paths GROUP BY d, turns
), places AS (
  SELECT paths.c, paths.d, m FROM paths JOIN nodes ON paths.d = nodes.d AND paths.turns = nodes.turns
), up AS (
  SELECT m, nodes.d, n, saved, (SELECT q.m FROM places AS q WHERE q.c = nodes.m AND q.d = nodes.d - 1) AS parent FROM nodes
), kids AS (
  SELECT parent, d - 1 AS d, count(*) AS n_children FROM up WHERE d > 0 GROUP BY parent, d
), full_up AS (
  SELECT up.*, coalesce(n_children, 0) AS n_children FROM up LEFT JOIN kids ON kids.parent = up.m AND kids.d = up.d
), totals AS (
  SELECT q.m, q.d, sum(CASE WHEN u.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(u.saved) AS saved
  FROM full_up AS u JOIN places AS q ON q.c = u.m AND q.d <= u.d GROUP BY q.m, q.d
), ends AS (
  SELECT q.m, q.d, string_agg(CAST(q.c AS VARCHAR), ',' ORDER BY q.c) AS ids
  FROM places AS q JOIN (SELECT c, max(d) AS d FROM places GROUP BY c) AS last ON q.c = last.c AND q.d = last.d GROUP BY q.m, q.d
)
SELECT f.m AS conv_id, CAST(f.d AS BIGINT) AS depth, f.parent AS parent_conv_id, CAST(f.n AS BIGINT) AS n_convs, CAST(f.n_children AS BIGINT) AS n_children,
       CAST(t.n_leaves AS BIGINT) AS n_leaves, CAST(t.saved AS BIGINT) AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM full_up AS f JOIN totals AS t ON f.m = t.m AND f.d = t.d LEFT JOIN ends AS e ON f.m = e.m AND f.d = e.d
"""


# Every phrase of one to three words is counted, without a prefilter.
OP13_COLLOCATIONS = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents
), words AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM pieces
), runs AS (
  SELECT lang, 1 AS k, unnest(w) AS phrase FROM words
  UNION ALL SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM words
  UNION ALL SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM words
), f AS (
  SELECT lang, k, phrase, count(*) AS f FROM runs GROUP BY lang, k, phrase
), c AS (
  SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 10
), cuts AS (
  SELECT c.*, x.cut, CAST(x.l AS BIGINT) AS l, CAST(x.r AS BIGINT) AS r, (CAST(1000000 AS HUGEINT) * a * a) // (CAST(x.l AS HUGEINT) * x.r) AS score FROM c JOIN (
    SELECT c.lang, c.phrase, u.cut, p.f AS l, q.f AS r FROM c, (SELECT unnest([1, 2]) AS cut) AS u, f AS p, f AS q
    WHERE u.cut < c.k AND p.lang = c.lang AND q.lang = c.lang
      AND p.phrase = array_to_string(c.w[1:u.cut], ' ') AND q.phrase = array_to_string(c.w[u.cut + 1:c.k], ' ')) AS x
    ON x.lang = c.lang AND x.phrase = c.phrase
), best AS (
  SELECT lang, k, phrase, a, l, r, CAST(score AS BIGINT) AS score FROM cuts
  QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), inside AS (
  SELECT lang, s AS phrase, max(a) AS most FROM (
    SELECT lang, a, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS s FROM c WHERE k = 3) GROUP BY lang, s
), kept AS (
  SELECT best.* FROM best LEFT JOIN inside ON best.lang = inside.lang AND best.phrase = inside.phrase
  WHERE NOT coalesce(100 * most >= 50 * a, FALSE)
), n AS (
  SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang
)
SELECT kept.lang, row_number() OVER (PARTITION BY kept.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept JOIN n ON kept.lang = n.lang QUALIFY rank <= 2000
"""


ORACLES: dict[str, str] = {
    "op1_license_scan": op1_license_scan(),
    "op3_line_dedup": OP3_LINE_DEDUP,
    "op5_decontamination": OP5_DECONTAMINATION,
    "op7_ngram_jaccard": OP7_NGRAM_JACCARD,
    "op9_quality_rules": OP9_QUALITY_RULES,
    "op11_prefix_trie": OP11_PREFIX_TRIE,
    "op13_collocations": OP13_COLLOCATIONS,
}
