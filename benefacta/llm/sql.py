"""DuckDB SQL that gives the rows of those queries that SQL can express."""

from __future__ import annotations

from . import ownership, poisson, risk

_WORD = r"[^\x20\x09-\x0D]+"


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _secrets() -> str:
    kinds = [*ownership.BASE, ownership.TOKEN]
    spans = " UNION ALL ".join(f"""
  SELECT doc_id, source, t, {kind} AS kind, i,
         regexp_extract_all(t, {_quoted(pattern)}) AS whole,
         regexp_extract_all(t, {_quoted(pattern)}, {group})[i] AS val,
         regexp_split_to_array(t, {_quoted(pattern)}) AS pieces, {least} AS least
  FROM (SELECT *, unnest(range(1, len(regexp_extract_all(t, {_quoted(pattern)})) + 1)) AS i FROM docs)"""
                               for kind, (_, pattern, group, least) in enumerate(kinds))
    names = "[" + ", ".join(f"'{k}'" for k, *_ in kinds) + "]"
    return f"""
WITH docs AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
raw AS ({spans}),
placed AS (
  SELECT doc_id, source, kind, val, whole[i] AS w,
         list_sum([length(x) for x in pieces[1:i]]) + coalesce(list_sum([length(x) for x in whole[1:i - 1]]), 0) AS s
  FROM raw WHERE length(val) >= least),
cand AS (SELECT doc_id, source, kind, sha256(val) AS h, CAST(s AS BIGINT) AS s, CAST(s + length(w) AS BIGINT) AS e, val,
                len(list_distinct(string_split(val, ''))) >= {ownership.LIVE_LETTERS} AND NOT regexp_matches(val, '{ownership.PLACEHOLDER}') AS live FROM placed),
chosen AS (
  SELECT * FROM cand c WHERE kind < {len(kinds) - 1} OR (
    regexp_matches(val, '[0-9]') AND regexp_matches(val, '[A-Z]') AND regexp_matches(val, '[a-z]')
    AND len(list_distinct(string_split(val, ''))) >= {ownership.TOKEN_LETTERS}
    AND NOT EXISTS (SELECT 1 FROM cand b WHERE b.doc_id = c.doc_id AND b.kind < {len(kinds) - 1} AND b.s < c.e AND c.s < b.e))),
owned AS (SELECT h, count(DISTINCT source) >= {ownership.EXAMPLE_OWNERS} AS copied FROM chosen GROUP BY h),
judged AS (SELECT c.*, copied, {names}[kind + 1] || ':' || s || ':' || e AS said FROM chosen c JOIN owned USING (h)),
shown AS (SELECT * FROM judged WHERE kind < {len(kinds) - 1} OR (live AND NOT copied))
SELECT d.doc_id,
       count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
       sha256(coalesce(string_agg(said, ',' ORDER BY s, kind) FILTER (kind < {len(kinds) - 1}), '')) AS base_sha256,
       coalesce(string_agg(said, ',' ORDER BY s, kind), '') AS spans,
       count(*) FILTER (live AND NOT copied) AS n_live, count(*) FILTER (copied) AS n_example, count(*) FILTER (NOT live AND NOT copied) AS n_dull
FROM documents d LEFT JOIN shown USING (doc_id) GROUP BY d.doc_id"""


_PASSAGES = f"""
WITH docs AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
windows AS (SELECT doc_id, i, array_to_string(w[i:i + 34], ' ') AS k
            FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM docs)),
again AS (SELECT k FROM windows GROUP BY k HAVING count(*) > 1),
covered AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS j FROM windows JOIN again USING (k)),
marked AS (SELECT doc_id, list(j) AS js FROM covered GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(len(js), 0) AS n_removed,
       sha256(coalesce(array_to_string([w[j] for j in range(1, len(w) + 1) if js IS NULL OR NOT list_contains(js, j)], ' '), '')) AS kept_sha256
FROM docs LEFT JOIN marked USING (doc_id)"""

_WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, strlen(h) AS n, sha1(h) AS x, min(page_id) OVER (PARTITION BY h) AS first FROM p),
b AS (SELECT *, array_to_string([printf('%04d', CAST(['0','1','10','11','100','101','110','111','1000','1001','1010','1011','1100',
        '1101','1110','1111'][strpos('0123456789abcdef', c)] AS INT)) for c in string_split(x, '')], '') AS bits FROM d)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
       array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
         16 * CAST(substr(bits, 5 * i + 1, 1) AS INT) + 8 * CAST(substr(bits, 5 * i + 2, 1) AS INT) + 4 * CAST(substr(bits, 5 * i + 3, 1) AS INT)
         + 2 * CAST(substr(bits, 5 * i + 4, 1) AS INT) + CAST(substr(bits, 5 * i + 5, 1) AS INT) AS INT), 1) for i in range(0, 32)], '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM b"""


def _rules() -> str:
    cutoffs = ", ".join(f"('{rule}', {level}, {cutoff}::DOUBLE)" for rule, (_, _, cuts) in risk.RULES.items() for level, cutoff in enumerate(cuts))
    over = " ".join(f"WHEN '{rule}' THEN {o}" for rule, (o, _, _) in risk.RULES.items())
    under = " ".join(f"WHEN '{rule}' THEN {u}" for rule, (_, u, _) in risk.RULES.items())
    blank = r"[\x20\x09-\x0D]"
    return f"""
WITH split AS (
  SELECT doc_id, lang, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w,
         [l for l in string_split(coalesce(text, ''), chr(10)) if regexp_matches(l, '{_WORD}')] AS lines FROM documents),
runs AS (SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM split)),
again AS (SELECT doc_id, k FROM runs GROUP BY doc_id, k HAVING count(*) > 1),
covered AS (SELECT doc_id, count(DISTINCT j) AS n FROM (
  SELECT doc_id, unnest(range(i, i + 5)) AS j FROM runs JOIN again USING (doc_id, k)) GROUP BY doc_id),
measured AS (
  SELECT doc_id, lang, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(t, '{blank}', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         len(lines) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words FROM split LEFT JOIN covered USING (doc_id)),
based AS (SELECT *, n_words < {risk.LEAST_WORDS} OR 100 * n_repeat_words > {risk.REPEAT_PERCENT} * n_words AS base_failed FROM measured),
known AS (SELECT doc_id, max(quality) AS label FROM labels WHERE quality IN (0, 1) GROUP BY doc_id),
good AS (SELECT b.*, label FROM based b JOIN known USING (doc_id) WHERE NOT base_failed),
cuts AS (SELECT * FROM (VALUES {cutoffs}) AS v(rule, level, cutoff)),
counts AS (
  SELECT lang, rule, level, cutoff, count(*) FILTER (label = 1) AS n,
         count(*) FILTER (label = 1 AND CASE rule {over} END > cutoff * CASE rule {under} END) AS k,
         count(*) FILTER (label = 0 AND CASE rule {over} END > cutoff * CASE rule {under} END) AS bad
  FROM good, cuts GROUP BY ALL),
tested AS (
  SELECT *, k < {risk.ALPHA} * n AND list_sum([exp(lgamma(n + 1) - lgamma(x + 1) - lgamma(n - x + 1) + x * ln({risk.ALPHA}) + (n - x) * ln(1 - {risk.ALPHA}))
            for x in range(0, k + 1)]) <= {risk.DELTA} / ({len(risk.RULES)} * (SELECT count(*) FROM (SELECT DISTINCT lang FROM good))) AS passes
  FROM counts),
allowed AS (SELECT *, sum(CASE WHEN passes THEN 0 ELSE 1 END) OVER (PARTITION BY lang, rule ORDER BY level) AS failures FROM tested),
best AS (SELECT lang, rule, arg_max(cutoff, bad * 1000 - level) AS cutoff FROM allowed WHERE failures = 0 GROUP BY lang, rule),
rejected AS (
  SELECT DISTINCT doc_id FROM based b JOIN best c ON b.lang IS NOT DISTINCT FROM c.lang
  WHERE CASE rule {over} END > cutoff * CASE rule {under} END)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND r.doc_id IS NULL AS kept
FROM based LEFT JOIN rejected r USING (doc_id)"""


_BENCHMARK = r"""
WITH fold AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
grams AS (SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS k
          FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM items WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM grams),
places AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS k
           FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM fold, sizes)),
hits AS (SELECT doc_id, item_id, i, n FROM places JOIN grams USING (n, k)),
found AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM hits GROUP BY doc_id),
words AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM fold LEFT JOIN found USING (doc_id) LEFT JOIN words USING (doc_id)"""

_MIXING = f"""
WITH RECURSIVE sizes AS (SELECT source, sum(length(coalesce(text, ''))) AS size FROM documents GROUP BY source),
rates AS (SELECT source, CASE WHEN size > 0 THEN pow(size, {poisson.TEMPERATURE}) / (SELECT sum(pow(size, {poisson.TEMPERATURE})) FROM sizes WHERE size > 0)
                 * (SELECT sum(size) FROM sizes) / size ELSE 1.0 END AS rate FROM sizes),
steps AS (
  SELECT source, rate, 0 AS j, -rate AS term, exp(-rate) AS cdf FROM rates
  UNION ALL
  SELECT source, rate, j + 1, term + ln(rate) - ln(j + 1), cdf + exp(term + ln(rate) - ln(j + 1)) FROM steps WHERE j + 1 <= ceil(rate + 12 * sqrt(rate) + 30)),
drawn AS (SELECT d.*, (CAST('0x' || substr(md5('{poisson.SEED}:' || d.doc_id), 1, 13) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE AS u FROM documents d),
counted AS (SELECT doc_id, text, lang, source, n_chars, (SELECT count(*) FROM steps s WHERE s.source IS NOT DISTINCT FROM drawn.source AND s.cdf <= u) AS n FROM drawn),
copied AS (SELECT doc_id, text, lang, source, n_chars, CAST(unnest(range(1, n + 1)) AS INT) AS copy FROM counted)
SELECT *, CAST('0x' || substr(md5('{poisson.SEED}:' || doc_id || ':' || copy), 1, 15) AS BIGINT) AS shuffle_key FROM copied"""

_MIDDLE = r"""
WITH cut AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS w,
                    sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
drawn AS (SELECT *, len(w) AS n, CAST('0x' || h[1:8] AS BIGINT) % (len(w) + 1) AS x, CAST('0x' || h[9:16] AS BIGINT) % (len(w) + 1) AS y,
                 CAST('0x' || h[25:32] AS BIGINT) % 100 < 50 AS suffix_first FROM cut),
parts AS (SELECT doc_id, t, n, CASE WHEN t = '' OR regexp_matches(t, '<[PSM]>') THEN 'plain' WHEN suffix_first THEN 'spm' ELSE 'psm' END AS form,
                 coalesce(array_to_string(w[1:least(x, y)], ''), '') AS p,
                 coalesce(array_to_string(w[least(x, y) + 1:greatest(x, y)], ''), '') AS m,
                 coalesce(array_to_string(w[greatest(x, y) + 1:], ''), '') AS s FROM drawn)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m ELSE t END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts"""

_LINKED = f"""
WITH RECURSIVE split AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') AS w
                         FROM documents),
grams AS MATERIALIZED (SELECT DISTINCT doc_id, array_to_string(w[i:i + least(3, len(w)) - 1], ' ') AS g
          FROM (SELECT doc_id, w, unnest(range(1, len(w) - least(3, len(w)) + 2)) AS i FROM split WHERE len(w) > 0)),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM grams x JOIN grams y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
links AS MATERIALIZED (SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * c >= 90 * (p.n + q.n - c)),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b)
SELECT s.doc_id, coalesce(n, 0) AS n_shingles, least(s.doc_id, coalesce(min(b), s.doc_id)) AS component_id
FROM split s LEFT JOIN sizes USING (doc_id) LEFT JOIN reach ON reach.a = s.doc_id GROUP BY s.doc_id, n"""


def _centroids(k: int = 40, rounds: int = 5, dimensions: int = 64) -> str:
    parts = [f"""
WITH v AS MATERIALIZED (
  SELECT vec_id, [CAST(floor(256 * CAST(y AS DOUBLE)) AS BIGINT) for y in embedding] AS x FROM embeddings
  WHERE len(embedding) = {dimensions} AND len([1 for y in embedding if y IS NOT NULL AND isfinite(y)]) = {dimensions}),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h) - 1 AS c, x FROM (
  SELECT sha256('2:' || vec_id) AS h, x FROM v ORDER BY h LIMIT {k}))"""]
    for i in range(rounds + 1):
        parts.append(f"""
a{i} AS MATERIALIZED (SELECT vec_id, any_value(x) AS x, min({{'d': d, 'c': c}}) AS near FROM (
  SELECT vec_id, v.x, c, list_sum([(p[1] - p[2]) * (p[1] - p[2]) for p in list_zip(v.x, m.x)]) AS d FROM v, c{i} m) GROUP BY vec_id)""")
        if i < rounds:
            parts.append(f"""
m{i} AS (SELECT c, list(mean ORDER BY i) AS x FROM (
  SELECT c, i, (s - ((s % n) + n) % n) // n AS mean FROM (
    SELECT near.c AS c, i, CAST(sum(x[i]) AS BIGINT) AS s, count(*) AS n FROM a{i}, range(1, {dimensions + 1}) AS r(i) GROUP BY ALL)) GROUP BY c),
c{i + 1} AS MATERIALIZED (SELECT o.c, coalesce(m{i}.x, o.x) AS x FROM c{i} o LEFT JOIN m{i} USING (c))""")
    return ",".join(parts) + f"""
SELECT vec_id, CAST(near.c AS INT) AS cluster, CAST(near.d AS BIGINT) AS distance,
       CAST(sum(near.d) OVER (PARTITION BY near.c) AS BIGINT) AS cluster_inertia, CAST(sum(near.d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(m.x, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} m ON m.c = near.c"""


ORACLES = {
    "op1_secret_ownership": _secrets(),
    "op3_phrase_automata": _PASSAGES,
    "op6_warc_round_trip": _WARC,
    "op7_risk_controlled_rules": _rules(),
    "op8_benchmark_decontamination": _BENCHMARK,
    "op9_poisson_mixing": _MIXING,
    "op11_chunk_memo_fim": _MIDDLE,
    "op12_skip_overlap_join": _LINKED,
    "op13_heap_bounded_centroids": _centroids(),
}
