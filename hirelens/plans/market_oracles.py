"""SQL for the queries of ``market_queries``."""

from __future__ import annotations

from hirelens import rules
from hirelens.functions.tokens import PII_PATTERNS
from hirelens.operators.market import ROLE_FAMILIES
from hirelens.plans.oracle_base import (
    cut,
    joined,
    over_parsed,
    quote,
    rank_of_level,
    strip,
    with_postings,
    years_rank,
)

_SKILL_ROWS = (
    "job_skills AS (SELECT doc_id, role_type, seniority_level, country, date_posted_normalized,"
    " unnest(list_sort(list_concat(req, opt))) AS skill FROM parsed)"
)
_RANK = rank_of_level("seniority_level")
_TOKENS = "regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+')"


_TERMS = (
    "terms AS MATERIALIZED (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id,"
    " unnest(regexp_extract_all(lower(description), '[\\p{L}\\p{N}]+')) AS term FROM parsed) GROUP BY ALL)"
)


def _frequency(name: str, by: str) -> str:
    """CTE of postings per skill in groups, with the size and share of the group."""
    on = " AND ".join(f"a.{b} IS NOT DISTINCT FROM t.{b}" for b in by.split(", ")) if by else "true"
    group, lead = (f" GROUP BY {by}", f"{by}, ") if by else ("", "")
    picked = ", ".join(f"a.{b}" for b in by.split(", ")) + ", " if by else ""
    return (
        f"{name} AS (SELECT {picked}skill, n, postings, n / postings AS share FROM (SELECT {lead}skill,"
        f" count(*) AS n FROM job_skills GROUP BY {lead}skill) a JOIN (SELECT {lead}count(*) AS postings"
        f" FROM parsed{group}) t ON {on})"
    )


_PROFILES = (
    _frequency("by_level", "role_type, seniority_level")
    + ", profiles AS (SELECT concat(b.role_type, ' | ', b.seniority_level) AS profile_id,"
    " b.role_type AS standardized_role, b.seniority_level AS profile_level,"
    " list(skill ORDER BY skill) AS held, any_value(y.years) AS experience_years FROM by_level b JOIN"
    " (SELECT role_type, seniority_level, CAST(round(avg(min_years_experience)) AS INTEGER) AS years"
    " FROM parsed GROUP BY ALL) y ON b.role_type = y.role_type AND b.seniority_level ="
    " y.seniority_level WHERE share >= 0.3 GROUP BY ALL)"
)
_PAIRS = (
    "pairs AS (SELECT doc_id, profile_id, role_type, seniority_level, experience_years, req, held,"
    " list_sort(list_concat(req, opt)) AS wanted FROM parsed JOIN profiles"
    " ON role_type = standardized_role)"
)
_WEIGHTS = _frequency("overall", "") + ", weights AS (SELECT skill, share, ln(postings / n) AS idf FROM overall)"


def _sum(of: str, value: str) -> str:
    return f"coalesce((SELECT sum({value}) FROM weights w WHERE list_contains({of}, w.skill)), 0)"


_BOTH = "list_intersect(wanted, held)"
_MATCH = (
    "matched AS (SELECT *, coalesce(CASE WHEN a * b > 0 THEN s / sqrt(a * b) END, 0) AS score FROM"
    f" (SELECT *, {_sum('wanted', 'idf * idf')} AS a, {_sum('held', 'idf * idf')} AS b,"
    f" {_sum(_BOTH, 'idf * idf')} AS s FROM pairs))"
)
_PAIR_COUNTS = (
    "pair_counts AS (SELECT x.skill AS a, y.skill AS b, count(*) AS n FROM job_skills x JOIN job_skills y"
    " ON x.doc_id = y.doc_id AND x.skill < y.skill GROUP BY ALL),"
    " singles AS (SELECT skill, count(*) AS n FROM job_skills GROUP BY skill),"
    " total AS (SELECT count(*) AS n FROM parsed),"
    " lifts AS (SELECT a, b, p.n, p.n / total.n AS support, p.n * total.n / (s.n * t.n) AS lift"
    " FROM pair_counts p JOIN singles s ON a = s.skill JOIN singles t ON b = t.skill CROSS JOIN total)"
)
_LARGEST = 12  # no set of so many skills is frequent at the given scales
_FEATURES = {
    "years": "min_years_experience",
    "skills": "len(req) + len(opt)",
    "tools": "len(tools)",
    "rank": _RANK,
    "chars": "length(description)",
}
_NAMES = list(_FEATURES)
_FAMILY = "CASE normalized_title " + " ".join(
    f"WHEN {quote(t)} THEN {quote(f)}" for t, f in ROLE_FAMILIES
) + " ELSE 'Other' END"


def _list(words) -> str:
    return "[" + ", ".join(map(quote, words)) + "]"


_CLEAN = (
    f"list_filter({_TOKENS}, lambda t: length(t) > 1 AND regexp_matches(t, '\\p{{L}}')"
    f" AND NOT list_contains({_list(rules.STOP_WORDS['en'])}, t))"
)
_MASKED = "text"
for _pattern, _to in PII_PATTERNS:
    _MASKED = f"regexp_replace({_MASKED}, '{_pattern}', '{_to}', 'g')"
_LANGUAGE_HITS = ", ".join(
    f"len(list_filter({_list(sorted(set(words)))}, lambda w: list_contains(types, w))) AS {lang}"
    for lang, words in rules.STOP_WORDS.items()
)
_LANGUAGE = "CASE " + " ".join(
    f"WHEN {lang} = greatest(en, fr, de, es) THEN '{lang}'" for lang in rules.STOP_WORDS
) + " END"
_GAIN = "(pow(2.0, quality) - 1) / log2(place + 1.0)"

ORACLES = {
    "skill_frequency": over_parsed(
        "SELECT role_type, seniority_level, skill, n, postings, round(share, 6) AS share FROM by_level",
        _SKILL_ROWS,
        _frequency("by_level", "role_type, seniority_level"),
    ),
    "skill_cooccurrence": over_parsed(
        "SELECT a, b, n, round(support, 6) AS support, round(lift, 6) AS lift FROM lifts",
        _SKILL_ROWS,
        _PAIR_COUNTS,
    ),
    "skill_motifs": over_parsed(
        " UNION ALL ".join(f"SELECT items, n FROM frequent{k}" for k in range(2, _LARGEST + 1)),
        _SKILL_ROWS,
        "total AS (SELECT count(*) AS n FROM parsed)",
        "sets1 AS (SELECT doc_id, skill AS items, skill AS last FROM job_skills)",
        *[
            f"sets{k} AS (SELECT s.doc_id, s.items || '|' || j.skill AS items, j.skill AS last FROM"
            f" sets{k - 1} s{'' if k == 2 else f' SEMI JOIN frequent{k - 1} USING (items)'} JOIN"
            f" job_skills j ON s.doc_id = j.doc_id AND s.last < j.skill), frequent{k} AS (SELECT items,"
            f" count(*) AS n FROM sets{k} GROUP BY items HAVING count(*) >= ceil(0.1 * (SELECT n FROM"
            " total)))"
            for k in range(2, _LARGEST + 1)
        ],
    ),
    "skill_seniority_by_region": over_parsed(
        "SELECT k.country, skill, count(*) FILTER (has) AS n, CAST(count(*) FILTER (has AND senior)"
        " AS BIGINT) AS senior, count(*) AS postings, round(corr(CAST(has AS INTEGER), CAST(senior AS"
        " INTEGER)), 6) AS correlation FROM (SELECT k.country, s.skill, list_contains(list_concat(k.req,"
        " k.opt), s.skill) AS has, senior FROM known k JOIN seen s ON k.country IS NOT DISTINCT FROM"
        " s.country) k GROUP BY ALL",
        f"known AS (SELECT *, {_RANK} >= 2 AS senior FROM parsed WHERE seniority_level <> 'Unknown')",
        "seen AS (SELECT DISTINCT country, unnest(list_concat(req, opt)) AS skill FROM known)",
    ),
    "correlation_matrix": over_parsed(
        " UNION ALL ".join(
            f"SELECT '{a}' AS a, '{b}' AS b, round(corr({_FEATURES[a]}, {_FEATURES[b]}), 6)"
            " AS correlation FROM parsed"
            for i, a in enumerate(_NAMES)
            for b in _NAMES[i + 1 :]
        )
    ),
    "skill_trend": over_parsed(
        "SELECT skill, CAST(month AS VARCHAR) AS month, n, previous, round(CASE WHEN previous > 0 THEN n /"
        " previous - 1 END, 6) AS growth, round(slope, 6) AS slope FROM (SELECT *, lag(n) OVER (PARTITION BY"
        " skill ORDER BY month) AS previous, CASE WHEN count(*) OVER (PARTITION BY skill) > 1 THEN"
        " regr_slope(n, place) OVER (PARTITION BY skill) END AS slope FROM (SELECT c.skill, c.month,"
        " coalesce(n, 0) AS n, date_diff('month', (SELECT min(month) FROM monthly), c.month) AS place FROM"
        " calendar c LEFT JOIN monthly m ON c.skill = m.skill AND c.month = m.month))",
        _SKILL_ROWS,
        "monthly AS (SELECT skill, CAST(date_trunc('month', CAST(date_posted_normalized AS DATE)) AS DATE) AS"
        " month, count(*) AS n FROM job_skills WHERE date_posted_normalized IS NOT NULL GROUP BY ALL)",
        "calendar AS (SELECT skill, CAST(unnest(generate_series((SELECT min(month) FROM monthly), (SELECT"
        " max(month) FROM monthly), INTERVAL 1 MONTH)) AS DATE) AS month FROM (SELECT DISTINCT skill FROM"
        " monthly))",
    ),
    "recent_window": over_parsed(
        "SELECT doc_id, date_posted_normalized AS day FROM parsed WHERE CAST(date_posted_normalized AS"
        " DATE) BETWEEN DATE '2025-11-19' AND DATE '2026-02-19'"
    ),
    "role_family": over_parsed(
        f"SELECT {_FAMILY} AS family, count(*) AS n FROM parsed GROUP BY 1"
    ),
    "tokenize": f"SELECT doc_id, CAST(len(t) AS INTEGER) AS n, md5(array_to_string(t, ' ')) AS hash FROM"
    f" (SELECT doc_id, {_TOKENS} AS t FROM documents)",
    "clean_tokens": "SELECT doc_id, CAST(len(t) AS INTEGER) AS n, md5(coalesce(array_to_string(t, ' '),"
    f" '')) AS hash FROM (SELECT doc_id, {_CLEAN} AS t FROM documents)",
    "ngrams": "SELECT d.doc_id, coalesce(n, 0) AS n, md5(coalesce(g, '')) AS hash FROM documents d LEFT"
    " JOIN (SELECT doc_id, CAST(count(*) AS INTEGER) AS n, string_agg(g, ' ' ORDER BY i) AS g FROM"
    " (SELECT doc_id, i, t || ' ' || lead(t) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM (SELECT"
    " doc_id, unnest(ts) AS t, generate_subscripts(ts, 1) AS i FROM (SELECT doc_id,"
    f" {_TOKENS} AS ts FROM documents))) WHERE g IS NOT NULL GROUP BY doc_id) x ON d.doc_id = x.doc_id",
    "lemmatize": f"WITH t AS (SELECT unnest({_TOKENS}) AS token FROM documents), l AS (SELECT DISTINCT"
    f" token FROM (SELECT unnest({_TOKENS}) AS token FROM conversations) WHERE ends_with(token, 's'))"
    " SELECT CASE WHEN l.token IS NULL THEN t.token ELSE rtrim(t.token, 's') END AS lemma, count(*) AS n"
    " FROM t LEFT JOIN l ON t.token = l.token GROUP BY 1",
    "language_filter": f"SELECT doc_id, language FROM (SELECT doc_id, CASE WHEN greatest(en, fr, de, es)"
    f" > 0 AND greatest(en, fr, de, es) >= 0.02 * len(types) THEN {_LANGUAGE} ELSE 'unknown' END AS"
    f" language FROM (SELECT doc_id, types, {_LANGUAGE_HITS} FROM (SELECT doc_id,"
    f" list_distinct({_TOKENS}) AS types FROM documents))) WHERE language IN ('en', 'de')",
    "pii_mask": "SELECT doc_id, CAST(len(regexp_extract_all(t, '\\[EMAIL\\]')) AS INTEGER) AS emails,"
    " CAST(len(regexp_extract_all(t, '\\[IP\\]')) AS INTEGER) AS ips,"
    " CAST(len(regexp_extract_all(t, '\\[PHONE\\]')) AS INTEGER) AS phones, md5(t) AS hash FROM"
    f" (SELECT doc_id, {_MASKED} AS t FROM documents)",
    "normalize_units": with_postings(
        "SELECT doc_id, CASE WHEN s LIKE '$120%' THEN 120000.0 WHEN s LIKE '€%' THEN 55000.0 WHEN s LIKE"
        " '£%' THEN 40.0 WHEN s LIKE 'USD%' THEN 9500.0 END::DOUBLE AS low, CASE WHEN s LIKE '$120%' THEN"
        " 150000.0 WHEN s LIKE '€%' THEN 55000.0 WHEN s LIKE '£%' THEN 40.0 WHEN s LIKE 'USD%' THEN 9500.0"
        " END::DOUBLE AS high, CASE WHEN s LIKE '$120%' OR s LIKE 'USD%' THEN 'USD' WHEN s LIKE '€%' THEN"
        " 'EUR' WHEN s LIKE '£%' THEN 'GBP' END AS currency, CASE WHEN s LIKE '%year' THEN 'year' WHEN s"
        " LIKE '%hour' THEN 'hour' WHEN s LIKE '%month' THEN 'month' END AS period FROM (SELECT doc_id,"
        " salary_raw AS s FROM postings)"
    ),
    "tfidf": f"WITH t AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest({_TOKENS}) AS"
    " term FROM documents) GROUP BY ALL), d AS (SELECT term, count(*) AS df FROM t GROUP BY term)"
    " SELECT doc_id, t.term, tf, df, round(tf * ln((SELECT count(*) FROM documents) / df), 6) AS weight"
    " FROM t JOIN d ON t.term = d.term",
    "boilerplate_share": with_postings(
        "SELECT doc_id, CAST(sum(n) AS BIGINT) AS chars, CAST(coalesce(sum(n) FILTER (companies >= 3), 0)"
        " AS BIGINT) AS shared_chars, round(coalesce(sum(n) FILTER (companies >= 3), 0) / sum(n), 6) AS"
        " share FROM (SELECT *, length(p) AS n FROM ps) JOIN (SELECT p, count(DISTINCT company) AS"
        " companies FROM ps GROUP BY p) USING (p) GROUP BY doc_id",
        f"ps AS (SELECT * FROM (SELECT doc_id, company, {strip('unnest(ps)')} AS p FROM (SELECT doc_id,"
        f" company, {cut('description')} AS ps FROM postings)) WHERE p <> '')",
    ),
    "near_dup": f"WITH RECURSIVE t AS (SELECT doc_id, md5(text) AS h, {_TOKENS} AS ts FROM documents),"
    " grams AS (SELECT doc_id, unnest(list_distinct(CASE WHEN len(ts) >= 3 THEN list_transform(range(1,"
    " len(ts) - 1), lambda i: array_to_string(ts[i:i + 2], ' ')) WHEN len(ts) > 0 THEN"
    " [array_to_string(ts, ' ')] ELSE [] END)) AS g FROM t), sizes AS (SELECT doc_id, count(*) AS n FROM"
    " grams GROUP BY doc_id), common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n FROM grams a"
    " JOIN grams b ON a.g = b.g GROUP BY ALL), links AS (SELECT x, y FROM common c JOIN sizes a ON c.x ="
    " a.doc_id JOIN sizes b ON c.y = b.doc_id WHERE c.n >= 0.8 * (a.n + b.n - c.n) UNION SELECT a.doc_id,"
    " b.doc_id FROM t a JOIN t b ON a.h = b.h), reach AS (SELECT x, y FROM links UNION SELECT r.x, l.y"
    ' FROM reach r JOIN links l ON r.y = l.x) SELECT x AS doc_id, min(y) AS "group" FROM reach GROUP BY x',
    "vocab_match_phrases": f"WITH b AS (SELECT {_TOKENS} AS ts FROM benchmark), phrases AS (SELECT DISTINCT"
    " array_to_string(ts[i:i + n - 1], ' ') AS phrase, n FROM (SELECT ts, n, unnest(range(1, len(ts) - n + 2)) AS i"
    f" FROM b, (VALUES (2), (3)) l(n))), d AS (SELECT doc_id, {_TOKENS} AS ts FROM documents), runs AS (SELECT"
    " doc_id, i - 1 AS place, array_to_string(ts[i:i + n - 1], ' ') AS phrase FROM (SELECT doc_id, ts, n,"
    " unnest(range(1, len(ts) - n + 2)) AS i FROM d, (VALUES (2), (3)) l(n))) SELECT doc_id, count(*) AS hits,"
    " count(DISTINCT phrase) AS phrases, CAST(sum(place) AS BIGINT) AS places, min(phrase) AS first FROM runs JOIN phrases"
    " USING (phrase) GROUP BY doc_id",
    "text_match_top": f"WITH sides AS (SELECT 'd' AS side, doc_id AS id, {_TOKENS} AS ts FROM documents UNION ALL"
    f" SELECT 'b', item_id, {_TOKENS} FROM benchmark), terms AS (SELECT side, id, term, count(*) AS tf FROM (SELECT"
    " side, id, unnest(ts) AS term FROM sides) GROUP BY ALL), weighted AS (SELECT side, id, t.term, tf *"
    " ln((SELECT count(*) FROM sides) / df) AS w FROM terms t JOIN (SELECT term, count(*) AS df FROM terms GROUP BY"
    " term) d ON t.term = d.term), unit AS (SELECT side, id, term, w / sqrt(sum(w * w) OVER (PARTITION BY side, id))"
    " AS w FROM weighted WHERE w > 0), scored AS (SELECT a.id AS doc_id, b.id AS item_id, round(sum(a.w * b.w), 9) AS"
    " score FROM unit a JOIN unit b ON a.term = b.term AND a.side = 'd' AND b.side = 'b' GROUP BY ALL) SELECT doc_id,"
    " item_id, round(score, 6) AS score, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, item_id) AS"
    " INTEGER) AS rank FROM scored WHERE score >= 0.2 QUALIFY rank <= 3",
    "archetypes": over_parsed(
        "SELECT doc_id, cluster FROM parsed LEFT JOIN nearest USING (doc_id)",
        _TERMS,
        "vectors AS MATERIALIZED (SELECT doc_id, term, weight / sqrt(sum(weight * weight) OVER (PARTITION"
        " BY doc_id)) AS w FROM (SELECT doc_id, t.term, tf * ln((SELECT count(*) FROM parsed) / df) AS"
        " weight FROM terms t JOIN (SELECT term, count(*) AS df FROM terms GROUP BY term) d ON t.term ="
        " d.term) WHERE weight > 0)",
        "near0 AS (SELECT doc_id, row_number() OVER (ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id) - 1 AS"
        " cluster FROM (SELECT DISTINCT doc_id FROM vectors) QUALIFY cluster < 6)",
        *[
            f"centres{i} AS MATERIALIZED (SELECT cluster, term, s / sqrt(sum(s * s) OVER (PARTITION BY"
            f" cluster)) AS weight FROM (SELECT cluster, term, sum(w) AS s FROM vectors v JOIN near{i} n ON"
            f" v.doc_id = n.doc_id GROUP BY ALL)), near{i + 1 if i < 3 else 'est'} AS MATERIALIZED (SELECT"
            " doc_id, CAST(cluster AS INTEGER) AS cluster FROM (SELECT doc_id, cluster, round(sum(w * weight),"
            f" 9) AS score FROM vectors v JOIN centres{i} c ON v.term = c.term GROUP BY ALL) QUALIFY"
            " row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, cluster) = 1)"
            for i in range(4)
        ],
    ),
    "role_classifier": over_parsed(
        "SELECT doc_id, role_type, out AS held_out, role AS predicted_role FROM (SELECT s.doc_id, s.role_type,"
        " s.out, s.role, row_number() OVER (PARTITION BY s.doc_id ORDER BY round(prior + n * unseen +"
        " coalesce(score, 0), 9) DESC, s.role) AS place FROM (SELECT * FROM split, role_rows) s LEFT JOIN (SELECT"
        " doc_id, role, sum(tf * ln(n + 1)) AS score FROM terms t JOIN counts c ON t.term = c.term GROUP BY"
        " ALL) f ON s.doc_id = f.doc_id AND s.role = f.role) WHERE place = 1",
        _TERMS,
        "split AS (SELECT doc_id, role_type, ('0x' || md5(CAST(doc_id AS VARCHAR))[1:8])::BIGINT % 5 = 0 AS"
        " out, len(regexp_extract_all(lower(description), '[\\p{L}\\p{N}]+')) AS n FROM parsed)",
        "counts AS MATERIALIZED (SELECT role_type AS role, term, sum(tf) AS n FROM terms JOIN split USING"
        " (doc_id) WHERE NOT out GROUP BY ALL)",
        "role_rows AS (SELECT role_type AS role, ln(count(*) / (SELECT count(*) FROM split WHERE NOT out)) AS prior,"
        " -ln((SELECT sum(n) FROM counts WHERE role = role_type) + (SELECT count(DISTINCT term) FROM"
        " counts)) AS unseen FROM split WHERE NOT out GROUP BY role_type)",
    ),
    "ideal_profiles": over_parsed(
        "SELECT profile_id, standardized_role, profile_level AS seniority_level,"
        f" {joined('held')} AS candidate_skills, experience_years, 'inferred' AS derived_from"
        " FROM profiles",
        _SKILL_ROWS,
        _PROFILES,
    ),
    "skills_coverage": over_parsed(
        f"SELECT doc_id, profile_id, round({_sum('list_intersect(req, held)', 'share')} /"
        f" nullif({_sum('req', 'share')}, 0), 6) AS coverage FROM pairs",
        _SKILL_ROWS,
        _PROFILES,
        _PAIRS,
        _WEIGHTS,
    ),
    "match_score": over_parsed(
        "SELECT doc_id, profile_id, round(score, 6) AS score FROM matched",
        _SKILL_ROWS,
        _PROFILES,
        _PAIRS,
        _WEIGHTS,
        _MATCH,
    ),
    "best_profiles": over_parsed(
        "SELECT doc_id, profile_id, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank FROM (SELECT *,"
        " row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, profile_id) AS rank FROM (SELECT"
        f" doc_id, profile_id, round(s / sqrt(a * b), 9) AS score FROM (SELECT *, {_sum('wanted', 'idf * idf')}"
        f" AS a, {_sum('held', 'idf * idf')} AS b, {_sum('list_intersect(wanted, held)', 'idf * idf')} AS s"
        " FROM wanted CROSS JOIN made) WHERE a * b > 0) WHERE score >= 0.5) WHERE rank <= 3",
        _SKILL_ROWS,
        _WEIGHTS,
        "wanted AS (SELECT doc_id, list_sort(list_concat(req, opt)) AS wanted FROM parsed)",
        "made AS (SELECT concat_ws(' | ', normalized_title, city, country) AS profile_id,"
        " list_distinct(flatten(list(list_concat(req, opt)))) AS held FROM parsed GROUP BY 1)",
    ),
    "explain_match": over_parsed(
        "SELECT doc_id, profile_id, CAST(place - 1 AS INTEGER) AS place, round(weight, 6) AS weight, skill"
        " FROM (SELECT doc_id, profile_id, w.skill, idf * idf AS weight, row_number() OVER (PARTITION BY"
        " doc_id, profile_id ORDER BY idf * idf DESC, w.skill) AS place FROM (SELECT doc_id, profile_id,"
        f" unnest({_BOTH}) AS skill FROM pairs) p JOIN weights w ON p.skill = w.skill) WHERE place <= 2",
        _SKILL_ROWS,
        _PROFILES,
        _PAIRS,
        _WEIGHTS,
    ),
    "skill_gap": over_parsed(
        "SELECT profile_id, skill, count(*) AS n FROM (SELECT profile_id, held, unnest(req) AS skill FROM"
        " pairs) WHERE NOT list_contains(held, skill) GROUP BY ALL",
        _SKILL_ROWS,
        _PROFILES,
        _PAIRS,
    ),
    "seniority_fit": over_parsed(
        f"SELECT doc_id, profile_id, round(1.0 - abs({years_rank('experience_years')} - {_RANK}) / 3.0, 6)"
        "::DOUBLE AS fit FROM pairs",
        _SKILL_ROWS,
        _PROFILES,
        _PAIRS,
    ),
    "role_alignment": over_parsed(
        "SELECT profile_id, round(sum(share) FILTER (h) / sum(share), 6) AS skill_alignment,"
        " round(coalesce(sum(share) FILTER (h AND t), 0) / sum(share) FILTER (t), 6) AS tool_alignment"
        " FROM (SELECT profile_id, share, list_contains(held, skill) AS h, skill IN (SELECT tool FROM"
        " tools) AS t FROM by_role JOIN profiles ON role_type = standardized_role) GROUP BY profile_id",
        _SKILL_ROWS,
        _PROFILES,
        _frequency("by_role", "role_type"),
    ),
    "combo_rarity": over_parsed(
        "SELECT profile_id, round(avg(coalesce(lift, 0)), 6) AS mean_lift FROM (SELECT x.profile_id,"
        " x.s AS a, y.s AS b FROM flat x JOIN flat y ON x.profile_id = y.profile_id AND x.s < y.s) p"
        " LEFT JOIN lifts l ON p.a = l.a AND p.b = l.b GROUP BY profile_id",
        _SKILL_ROWS,
        _PROFILES,
        _PAIR_COUNTS,
        "flat AS (SELECT profile_id, unnest(held) AS s FROM profiles)",
    ),
    "rank_profiles": over_parsed(
        "SELECT *, rank() OVER (PARTITION BY role_type, seniority_level ORDER BY score DESC) AS rank FROM"
        " (SELECT role_type, seniority_level, profile_id, round(avg(score), 12) AS score FROM matched"
        " GROUP BY ALL)",
        _SKILL_ROWS,
        _PROFILES,
        _PAIRS,
        _WEIGHTS,
        _MATCH,
    ),
    "ranking_metrics": "WITH j AS (SELECT source, doc_id, n_chars, quality FROM documents JOIN labels"
    " USING (doc_id)), r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC,"
    " doc_id) AS place FROM j), i AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY quality"
    f" DESC, doc_id) AS place FROM j) SELECT source, items, round(dcg / nullif(ideal, 0), 6) AS ndcg,"
    " round(coalesce(1.0 / first, 0), 6)::DOUBLE AS reciprocal_rank FROM (SELECT source, count(*) AS"
    f" items, sum({_GAIN}) FILTER (place <= 5) AS dcg, min(place) FILTER (quality > 0) AS first FROM r"
    f" GROUP BY source) JOIN (SELECT source, sum({_GAIN}) FILTER (place <= 5) AS ideal FROM i GROUP BY"
    " source) USING (source)",
    "calibration": "WITH j AS (SELECT quality, n_chars / (n_chars + 500) AS p FROM documents JOIN labels USING"
    " (doc_id)), bins AS (SELECT bin, count(*) AS n, sum(p) AS p, sum(quality) AS y FROM (SELECT *, CAST(10 *"
    " (rank() OVER (ORDER BY p) - 1) // (SELECT count(*) FROM j) AS INTEGER) AS bin FROM j) GROUP BY bin), spans"
    " AS (SELECT a.bin AS first, b.bin AS last, sum(c.y) / sum(c.n) AS mean FROM bins a JOIN bins b ON a.bin <="
    " b.bin JOIN bins c ON c.bin BETWEEN a.bin AND b.bin GROUP BY ALL), least AS (SELECT i.bin, s.first,"
    " min(mean) AS mean FROM bins i JOIN spans s ON i.bin BETWEEN s.first AND s.last GROUP BY ALL), curve AS"
    " (SELECT bin, max(mean) AS calibrated FROM least GROUP BY bin) SELECT *, error <= 0.05 AS within FROM"
    " (SELECT b.bin, n, round(p / n, 6) AS predicted, round(y / n, 6) AS observed, round(abs(p / n - y / n), 6)"
    " AS error, round(calibrated, 6) AS calibrated FROM bins b JOIN curve c ON b.bin = c.bin)",
}
