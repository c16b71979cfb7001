"""The registered queries as DuckDB SQL."""

from __future__ import annotations

from corvine.functions.keys import ADDRESS_STOPWORDS, NAME_STOPWORDS
from corvine.functions.text import LEGAL_SUFFIXES
from corvine.plans import queries as q
from corvine.plans import views

_WORD = r"'[\p{L}\p{N}_]'"


def _expanded(text: str) -> str:
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in LEGAL_SUFFIXES.items())
    return f"array_to_string(list_transform(string_split({text}, ' '), lambda t: CASE t {cases} ELSE t END), ' ')"


def _normal(column: str) -> str:
    text = f"replace(lower(nfc_normalize(coalesce({column}, ''))), '&', ' and ')"
    return _expanded(rf"trim(regexp_replace(regexp_replace({text}, '\p{{P}}', ' ', 'g'), '\s+', ' ', 'g'))")


def _grams(text: str) -> str:
    of_word = "lambda w: flatten(list_transform(range(least(3, length(w) + 2), least(5, length(w) + 2) + 1), lambda n: list_transform(range(1, length(w) + 4 - n), lambda i: substring(concat(' ', w, ' '), i, n))))"
    return f"flatten(list_transform(list_filter(string_split({text}, ' '), lambda w: w <> ''), {of_word}))"


_BASE = f"docs_src AS ({views.DOCS}), parts_src AS ({views.PARTS}), doc_truth AS ({views.TRUTH}), truth AS ({views.PART_TRUTH})"
_BASE += ", " + ", ".join(f"{t} AS (SELECT *, {_normal('business_name')} AS normalized_name, {_normal('business_address')} AS normalized_address FROM {t}_src)" for t in ("docs", "parts"))


def _keyed(table: str) -> str:
    """name_k, address_k and record_k of a table: (entity_id, src, ord, country, block_key, i)."""
    return rf"""
{table}_name1 AS (
  SELECT *, list_filter(list_transform(string_split_regex(normalized_name, '\b(?:dba|doing business as|d/b/a|t/a|trading as)\b'),
    lambda p: list_filter(string_split(p, ' '), lambda t: length(t) >= 2 AND NOT list_contains({NAME_STOPWORDS}, t) AND regexp_matches(t, {_WORD}))), lambda p: len(p) > 0) AS parts,
    list_filter(string_split(normalized_name, ' '), lambda t: regexp_matches(t, {_WORD})) AS words FROM {table}
), {table}_name2 AS (
  SELECT *, CASE WHEN len(parts) > 0 THEN parts WHEN len(words) > 0 THEN [words] ELSE [] END AS used FROM {table}_name1
), {table}_name3 AS (SELECT *, list_sort(list_distinct(flatten(used))) AS s FROM {table}_name2),
{table}_name AS (
  SELECT entity_id, list_concat(list_concat(list_transform(used, lambda p: concat('NF_', substring(p[1], 1, 4))),
    CASE WHEN len(s) > 0 THEN [concat('NS_', substring(s[1], 1, 4))] ELSE [] END), CASE WHEN len(s) > 1 THEN [concat('NS2_', substring(s[2], 1, 4))] ELSE [] END) AS l FROM {table}_name3
), {table}_address1 AS (
  SELECT *, list_filter(string_split(normalized_address, ' '), lambda t: t <> '') AS tokens FROM {table}
), {table}_address2 AS (
  SELECT *, list_filter(list_transform(tokens, lambda t: CASE WHEN regexp_matches(t, '^[0-9]{{1,8}}$') THEN CAST(t AS BIGINT) END), lambda n: n > 0) AS nums,
    list_filter(tokens, lambda t: NOT regexp_matches(t, '^[0-9]+$') AND NOT list_contains({ADDRESS_STOPWORDS}, t) AND length(t) >= 3 AND regexp_matches(t, {_WORD})) AS words FROM {table}_address1
), {table}_address3 AS (
  SELECT *, list_filter(nums, lambda n, i: list_position(nums, n) = i)[1:2] AS two, list_concat(words[1:3], CASE WHEN len(words) > 3 THEN [words[-1]] ELSE [] END) AS near,
    list_transform(list_sort(list_distinct(words))[1:3], lambda w: substring(w, 1, 4)) AS s FROM {table}_address2
), {table}_address AS (
  SELECT entity_id, list_concat(flatten(list_transform(two, lambda n: list_transform(near, lambda w: concat('ANW_', CAST(n AS VARCHAR), '_', substring(w, 1, 4))))),
    CASE len(s) WHEN 3 THEN [concat('AWP_', s[1], '_', s[2]), concat('AWP_', s[1], '_', s[3]), concat('AWP_', s[2], '_', s[3])] WHEN 2 THEN [concat('AWP_', s[1], '_', s[2])] ELSE [] END) AS l FROM {table}_address3
), {table}_k AS (
  SELECT entity_id, k AS block_key, min(i) AS i FROM (
    SELECT entity_id, unnest(l) AS k, generate_subscripts(l, 1) AS i FROM (SELECT entity_id, list_concat(a.l, n.l) AS l FROM {table}_address a JOIN {table}_name n USING (entity_id))
  ) GROUP BY entity_id, k
), {table}_keys AS (
  SELECT entity_id, src, ord, coalesce(trim(country), '') AS country, block_key, row_number() OVER (PARTITION BY entity_id ORDER BY CASE WHEN starts_with(block_key, 'ANW_') THEN 1 WHEN starts_with(block_key, 'NF_') THEN 2
    WHEN starts_with(block_key, 'AWP_') THEN 3 WHEN starts_with(block_key, 'NS_') THEN 4 ELSE 5 END, i) - 1 AS pos
  FROM {table}_k JOIN {table} USING (entity_id)
), {table}_stats AS (SELECT country, block_key, count(*) AS n FROM {table}_keys WHERE src > 1 GROUP BY country, block_key)"""


def _candidates(table: str, limits) -> str:
    return f"""
{table}_asked AS (
  SELECT k.entity_id AS source1_entity_id, country, block_key, pos, n, min(pos) OVER (PARTITION BY k.entity_id) AS first
  FROM {table}_keys k JOIN {table}_stats USING (country, block_key) WHERE src = 1
), {table}_post AS (
  SELECT country, block_key, entity_id AS candidate_id, src, ord, row_number() OVER (PARTITION BY country, block_key ORDER BY src, ord) AS nth FROM {table}_keys WHERE src > 1
), {table}_met AS (
  SELECT source1_entity_id, candidate_id, min((pos, src, ord)) AS place FROM {table}_asked JOIN {table}_post USING (country, block_key)
  WHERE n <= {limits.max_block} OR (pos = first AND nth <= {limits.sample}) GROUP BY source1_entity_id, candidate_id
), {table}_cand AS (
  SELECT source1_entity_id, candidate_id, row_number() OVER (PARTITION BY source1_entity_id ORDER BY place, candidate_id) AS rank FROM {table}_met QUALIFY rank <= {limits.cap}
), {table}_compact AS (
  SELECT s.entity_id AS source1_entity_id, coalesce(string_agg(candidate_id, ',' ORDER BY rank), '') AS candidate_entity_ids
  FROM {table} s LEFT JOIN {table}_cand c ON s.entity_id = c.source1_entity_id WHERE src = 1 GROUP BY s.entity_id
), {table}_pairs AS (
  SELECT c.source1_entity_id, c.candidate_id, a.business_name AS s1_name, a.business_address AS s1_address, a.country AS s1_country, b.business_name AS cand_name, b.business_address AS cand_address,
    b.country AS cand_country, a.normalized_name AS s1_norm_name, a.normalized_address AS s1_norm_address, b.normalized_name AS cand_norm_name, b.normalized_address AS cand_norm_address
  FROM {table}_cand c LEFT JOIN {table} a ON a.entity_id = c.source1_entity_id LEFT JOIN {table} b ON b.entity_id = c.candidate_id
)"""


def _tfidf(table: str, kind: str) -> str:
    t = f"{table}_{kind}v"
    return f"""
{t}_tf AS (SELECT entity_id, term, count(*) AS tf FROM (SELECT entity_id, unnest({_grams(f'normalized_{kind}')}) AS term FROM {table}) GROUP BY entity_id, term),
{t} AS (SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS total, ln(((SELECT count(*) FROM {table}) + 1) / (count(*) + 1)) + 1 AS idf FROM {t}_tf GROUP BY term HAVING count(*) >= 2 ORDER BY total DESC, term LIMIT 100000),
{t}_w AS (SELECT entity_id, term, (1 + ln(tf)) * idf AS w FROM {t}_tf JOIN {t} USING (term)),
{t}_n AS (SELECT entity_id, sqrt(sum(w * w)) AS norm FROM {t}_w GROUP BY entity_id),
{t}_p AS (SELECT entity_id, term, w / norm AS w FROM {t}_w JOIN {t}_n USING (entity_id)),
{t}_sim AS (
  SELECT source1_entity_id, candidate_id, sum(a.w * b.w) AS sim FROM {table}_cand c JOIN {t}_p a ON a.entity_id = c.source1_entity_id JOIN {t}_p b ON b.entity_id = c.candidate_id AND a.term = b.term
  GROUP BY source1_entity_id, candidate_id
)"""


_FLAGS = """CASE WHEN s1_norm_name = '' THEN 1 ELSE 0 END AS name_is_missing, CASE WHEN s1_norm_address = '' OR cand_norm_address = '' THEN 1 ELSE 0 END AS address_is_missing,
    CASE WHEN coalesce(s1_country, '') = coalesce(cand_country, '') THEN 1 ELSE 0 END AS country_match"""
_PARTS = ", ".join([_BASE, _keyed("parts"), _candidates("parts", q.LIMITS)])
_GUARDED = ", ".join([_BASE, _keyed("parts"), _candidates("parts", q.GUARDED)])
_SCORED = ", ".join(
    [
        _PARTS, _tfidf("parts", "name"), _tfidf("parts", "address"),
        f"""scored AS (
  SELECT p.source1_entity_id, p.candidate_id, round_even(coalesce(n.sim, 0), 4) AS name_similarity, round_even(coalesce(a.sim, 0), 4) AS address_similarity, {_FLAGS},
    round_even(0.6::DOUBLE * coalesce(n.sim, 0) + 0.4::DOUBLE * coalesce(a.sim, 0), 4) AS combined_score
  FROM parts_pairs p LEFT JOIN parts_namev_sim n USING (source1_entity_id, candidate_id) LEFT JOIN parts_addressv_sim a USING (source1_entity_id, candidate_id)
), accepted AS (
  SELECT DISTINCT source1_entity_id, candidate_id FROM scored WHERE combined_score > {q.THRESHOLD} AND (starts_with(candidate_id, 'S2-') OR starts_with(candidate_id, 'S3-'))
), spine AS (SELECT entity_id AS source1_entity_id, country FROM parts WHERE src = 1),
matched AS (
  SELECT source1_entity_id, coalesce(string_agg(candidate_id, ',' ORDER BY candidate_id), '') AS matched_entity_ids FROM spine LEFT JOIN accepted USING (source1_entity_id) GROUP BY source1_entity_id
)""",
    ]
)
_F = """CASE WHEN np = 0 AND nt = 0 THEN 1 WHEN np = 0 THEN 0 ELSE tp / np END AS p, CASE WHEN np = 0 AND nt = 0 THEN 1 WHEN nt = 0 THEN 0 ELSE tp / nt END AS r"""
_AVG = "round_even(avg(CASE WHEN 0.25::DOUBLE * p + r = 0 THEN 0 ELSE 1.25::DOUBLE * p * r / (0.25::DOUBLE * p + r) END), 6) AS f, round_even(avg(p), 6) AS precision, round_even(avg(r), 6) AS recall"


def _macro(by: str = "") -> str:
    return f"""WITH {_SCORED}, counts AS (
  SELECT source1_entity_id, country, (SELECT count(*) FROM truth t JOIN accepted a ON a.source1_entity_id = t.source1_entity_id AND a.candidate_id = t.matched_id WHERE t.source1_entity_id = s.source1_entity_id) AS tp,
    (SELECT count(*) FROM accepted a WHERE a.source1_entity_id = s.source1_entity_id) AS np, (SELECT count(*) FROM truth t WHERE t.source1_entity_id = s.source1_entity_id) AS nt FROM spine s
), each AS (SELECT *, {_F} FROM counts)
SELECT {by + ',' if by else ''} {_AVG} FROM each {'GROUP BY ' + by if by else ''}"""


_SWEEP = f"""WITH {_SCORED}, thresholds AS (SELECT unnest(range(0, {len(q.THRESHOLDS)}))::INT AS position, unnest({q.THRESHOLDS})::DOUBLE AS threshold),
hits AS (
  SELECT position, s.source1_entity_id, count(t.matched_id) AS tp, count(*) AS np FROM scored s JOIN thresholds ON combined_score > threshold
  LEFT JOIN truth t ON t.source1_entity_id = s.source1_entity_id AND t.matched_id = s.candidate_id GROUP BY position, s.source1_entity_id
), counts AS (
  SELECT position, threshold, coalesce(tp, 0) AS tp, coalesce(np, 0) AS np, (SELECT count(*) FROM truth t WHERE t.source1_entity_id = s.source1_entity_id) AS nt
  FROM spine s CROSS JOIN thresholds LEFT JOIN hits USING (position, source1_entity_id)
), each AS (SELECT *, {_F} FROM counts), sweep AS (SELECT position, threshold, {_AVG} FROM each GROUP BY position, threshold)
"""


def _vocabulary(table: str, kind: str) -> str:
    return f"WITH {_BASE}, {table}_cand AS (SELECT '' AS source1_entity_id, '' AS candidate_id), {_tfidf(table, kind)}"


ORACLES = {
    "normalize_text": f"WITH {_BASE} SELECT entity_id, src, ord, normalized_name, normalized_address FROM docs UNION ALL SELECT entity_id, src, ord, normalized_name, normalized_address FROM parts",
    "suffix_expand": f"WITH {_BASE} SELECT entity_id, {_expanded(chr(10).join(['lower(regexp_replace(business_name,', repr('[.&]') + ',', repr('') + ',', repr('g') + '))']))} AS expanded FROM parts_src",
    "name_key_list": f"WITH {_BASE}, {_keyed('parts')} SELECT entity_id, block_key, (row_number() OVER (PARTITION BY entity_id ORDER BY i) - 1)::INT AS i FROM (SELECT entity_id, k AS block_key, min(i) AS i FROM (SELECT entity_id, unnest(l) AS k, generate_subscripts(l, 1) AS i FROM parts_name) GROUP BY 1, 2)",
    "address_key_list": f"WITH {_BASE}, {_keyed('docs')} SELECT entity_id, block_key, (row_number() OVER (PARTITION BY entity_id ORDER BY i) - 1)::INT AS i FROM (SELECT entity_id, k AS block_key, min(i) AS i FROM (SELECT entity_id, unnest(l) AS k, generate_subscripts(l, 1) AS i FROM docs_address) GROUP BY 1, 2)",
    "record_keys": f"WITH {_BASE}, {_keyed('parts')} SELECT entity_id, country, block_key, pos::INT AS pos FROM parts_keys",
    "block_stats": f"WITH {_BASE}, {_keyed('parts')} SELECT * FROM parts_stats",
    "block_oversize": f"WITH {_BASE}, {_keyed('parts')} SELECT * FROM parts_stats WHERE n > {q.GUARDED.max_block}",
    "candidates_tiered_cap": f"WITH {_PARTS} SELECT source1_entity_id, candidate_id, rank::INT AS rank FROM parts_cand",
    "candidates_guarded": f"WITH {_GUARDED} SELECT source1_entity_id, candidate_id, rank::INT AS rank FROM parts_cand",
    "candidates_compact": f"WITH {_PARTS} SELECT * FROM parts_compact",
    "pair_explode": f"WITH {_PARTS} SELECT source1_entity_id, unnest(string_split(candidate_entity_ids, ',')) AS candidate_id FROM parts_compact WHERE candidate_entity_ids <> ''",
    "pair_metadata_join": f"WITH {_PARTS} SELECT * FROM parts_pairs",
    "tfidf_vocab": f"{_vocabulary('docs', 'name')} SELECT term, df, total, round_even(idf, 6) AS idf FROM docs_namev",
    "tfidf_pair_cosine": f"WITH {_PARTS}, {_tfidf('parts', 'name')} SELECT DISTINCT s1_norm_name, cand_norm_name, round_even(sim, 4) AS similarity FROM parts_namev_sim JOIN parts_pairs USING (source1_entity_id, candidate_id)",
    "pair_features": f"WITH {_SCORED} SELECT * FROM scored",
    "accept_group": f"WITH {_SCORED} SELECT * FROM matched",
    "macro_f05": _macro(),
    "macro_f05_by_country": _macro("country"),
    "threshold_sweep": f"{_SWEEP} SELECT * FROM sweep",
    "threshold_argmax": f"{_SWEEP} SELECT threshold, f FROM sweep ORDER BY f DESC, position LIMIT 1",
    "blocking_recall_rollup": f"""WITH {_PARTS}, hit AS (SELECT a.country, c.candidate_id IS NOT NULL AS ok FROM truth t LEFT JOIN parts_cand c ON c.source1_entity_id = t.source1_entity_id AND c.candidate_id = t.matched_id LEFT JOIN parts a ON a.entity_id = t.source1_entity_id)
SELECT CASE WHEN grouping(country) = 1 THEN '(all)' ELSE coalesce(country, '') END AS country, count(*) AS n_truth, count(*) FILTER (WHERE ok) AS n_found, round_even(count(*) FILTER (WHERE ok) * 100.0::DOUBLE / count(*), 6) AS recall FROM hit GROUP BY ROLLUP (country)""",
    "candidate_size_stats": f"""WITH {_PARTS}, sizes AS (SELECT entity_id, count(candidate_id) AS size FROM parts LEFT JOIN parts_cand ON source1_entity_id = entity_id WHERE src = 1 GROUP BY entity_id), l AS (SELECT list(size ORDER BY size) AS s, count(*) AS n, avg(size) AS mean FROM sizes)
SELECT round_even(mean, 6) AS mean, s[-1] AS largest, s[CAST(floor(n / 2) AS BIGINT) + 1] AS median, s[CAST(floor(n * 0.95::DOUBLE) AS BIGINT) + 1] AS p95 FROM l""",
    "score_quantiles": f"""WITH {_SCORED}, l AS (SELECT list(combined_score ORDER BY combined_score) AS s, count(*) AS n, avg(combined_score) AS mean FROM scored)
SELECT round_even(mean, 6) AS mean, {", ".join(f"s[CAST(round((n - 1) * {p / 100}) AS BIGINT) + 1] AS p{p}" for p in (50, 90, 95, 99))} FROM l""",
    "top10_scores": f"WITH {_SCORED} SELECT source1_entity_id, candidate_id, combined_score FROM scored ORDER BY combined_score DESC, source1_entity_id, candidate_id LIMIT 10",
    "embedding_cosine": """SELECT a.vec_id, CASE WHEN a.vec_id % 7 = 0 OR b.vec_id IS NULL THEN 0.0::DOUBLE ELSE round_even(list_sum(list_transform(range(1, len(a.embedding) + 1), lambda i: a.embedding[i]::DOUBLE * b.embedding[i]::DOUBLE)), 4) END AS emb_name_similarity
FROM embeddings a LEFT JOIN embeddings b ON b.vec_id = a.vec_id + 1""",
    "length_features": f"""WITH {_PARTS} SELECT source1_entity_id, candidate_id, {_FLAGS}, abs(length(s1_norm_name) - length(cand_norm_name))::DOUBLE AS name_len_diff,
  round_even(least(length(s1_norm_name), length(cand_norm_name)) / greatest(length(s1_norm_name), length(cand_norm_name), 1), 6) AS name_len_ratio, abs(length(s1_norm_address) - length(cand_norm_address))::DOUBLE AS addr_len_diff FROM parts_pairs""",
    "unseen_countries": f"WITH {_BASE} SELECT DISTINCT country FROM docs_src WHERE src = 1 AND country IS NOT NULL AND country NOT IN ('en', 'fr')",
    "variant_cutoffs": f"""WITH {_SCORED}, chosen AS (SELECT s.source1_entity_id, s.candidate_id FROM scored s JOIN spine USING (source1_entity_id) WHERE combined_score > 0.15 AND combined_score > CASE WHEN country IN ('US', 'France') THEN {q.CUTOFF} ELSE {q.UNSEEN_CUTOFF} END)
SELECT source1_entity_id, coalesce(string_agg(candidate_id, ',' ORDER BY candidate_id), '') AS matched_entity_ids FROM spine LEFT JOIN chosen USING (source1_entity_id) GROUP BY source1_entity_id""",
    "validate_output": f"""WITH {_PARTS}, results AS (
  SELECT source1_entity_id, CASE WHEN x % 11 = 0 THEN 'S2-1,S2-1' WHEN x % 13 = 0 THEN 'S1-3' ELSE candidate_entity_ids END AS ids FROM (SELECT *, CAST(substring(source1_entity_id, 4) AS BIGINT) AS x FROM parts_compact) WHERE x % 17 <> 0
), each AS (SELECT source1_entity_id, unnest(string_split(ids, ',')) AS id FROM results WHERE ids <> '')
SELECT 'record_missing' AS rule, 'error' AS kind, count(*) AS n FROM parts WHERE src = 1 AND entity_id NOT IN (SELECT source1_entity_id FROM results)
UNION ALL SELECT 'record_unknown', 'error', count(*) FROM results WHERE source1_entity_id NOT IN (SELECT entity_id FROM parts WHERE src = 1)
UNION ALL SELECT 'record_repeated', 'error', count(*) FROM (SELECT 1 FROM results GROUP BY source1_entity_id HAVING count(*) > 1)
UNION ALL SELECT 'id_repeated', 'error', count(*) FROM results WHERE ids <> '' AND len(list_distinct(string_split(ids, ','))) < len(string_split(ids, ','))
UNION ALL SELECT 'id_prefix', 'error', count(*) FROM each WHERE NOT (starts_with(id, 'S2-') OR starts_with(id, 'S3-'))
UNION ALL SELECT 'id_unknown', 'warning', count(*) FROM each WHERE id NOT IN (SELECT entity_id FROM parts WHERE src > 1)
UNION ALL SELECT 'not_a_candidate', 'warning', count(*) FROM each e WHERE NOT EXISTS (SELECT 1 FROM parts_cand c WHERE c.source1_entity_id = e.source1_entity_id AND c.candidate_id = e.id)""",
    "label_pairs": f"WITH {_PARTS} SELECT source1_entity_id, candidate_id, CASE WHEN (source1_entity_id, candidate_id) IN (SELECT (source1_entity_id, matched_id) FROM truth) THEN 1 ELSE 0 END AS label FROM parts_cand",
    "truth_semi_join": f"WITH {_BASE} SELECT * FROM doc_truth WHERE source1_entity_id IN (SELECT entity_id FROM docs_src WHERE src = 1 ORDER BY ord LIMIT 100)",
    "unique_names": f"WITH {_BASE} SELECT DISTINCT normalized_name AS name FROM parts WHERE normalized_name <> ''",
    "decision_summary": f"WITH {_SCORED} SELECT (SELECT count(*) FROM accepted) AS n_pairs, count(*) FILTER (WHERE matched_entity_ids <> '') AS n_matched, round_even((SELECT count(*) FROM accepted) / count(*), 6) AS pairs_each FROM matched",
}
