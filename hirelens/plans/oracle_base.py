"""SQL building blocks of the checks: the postings, and the parser restated relationally.

The restatement is on purpose another one than the library's: paragraphs are rows, the section is
a running window, skills come from a join with the vocabulary.
"""

from __future__ import annotations

from hirelens import rules
from hirelens.plans.inputs import POSTINGS_SQL


def quote(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def values(rows, columns: str, name: str) -> str:
    body = ", ".join(
        "(" + ", ".join(quote(v) if isinstance(v, str) else str(v) for v in row) + ")" for row in rows
    )
    return f"{name}({columns}) AS (VALUES {body})"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def first_hit(text: str, table, default: str = "NULL") -> str:
    arms = " ".join(f"WHEN contains({text}, {quote(k)}) THEN {quote(v)}" for k, v in table)
    return f"CASE {arms} ELSE {default} END"


def escape(word: str) -> str:
    return "".join(ch if ch.isalnum() or ch == " " else "\\" + ch for ch in word)


def with_postings(select: str, *more: str) -> str:
    return "WITH " + ", ".join((f"postings AS ({POSTINGS_SQL})", *more)) + " " + select


def over_postings(columns: str) -> str:
    return with_postings(f"SELECT doc_id, {columns} FROM postings")


VOCABULARY = values(
    [(v, c, int(len(v) <= rules.SKILL_BOUNDED_UP_TO), f"(^|[^a-zA-Z]){escape(v)}([^a-zA-Z]|$)")
     for v, c in rules.SKILLS],
    "variant, skill, bounded, pattern",
    "vocabulary",
)
HIT = (
    "CASE WHEN v.bounded = 1 THEN regexp_matches(p.low, v.pattern)"
    " ELSE contains(p.low, v.variant) END"
)
TOOLS = values([(t,) for t in rules.TOOLS], "tool", "tools")


def cut(text: str) -> str:
    """Paragraphs of a text as a list."""
    return (
        f"string_split(regexp_replace(regexp_replace({text}, '\\n{{2,}}', chr(1), 'g'),"
        " '\\n([A-Z•●■-])', chr(1) || '\\1', 'g'), chr(1))"
    )


def label(paragraph: str) -> str:
    head = f"substring({paragraph}, 1, {rules.HEADING_WINDOW})"
    return (
        f"CASE WHEN regexp_matches({head}, '(?i)({rules.REQUIRED_HEADING})') THEN 'required'"
        f" WHEN regexp_matches({head}, '(?i)({rules.OPTIONAL_HEADING})') THEN 'optional' END"
    )


def paragraphs(source: str = "postings", text: str = "description") -> str:
    """CTEs ``cut`` and ``paragraphs(doc_id, pos, p, low, state)``."""
    return (
        f"cut AS (SELECT doc_id, {cut(text)} AS ps FROM {source}),"
        " rows_ AS (SELECT doc_id, unnest(ps) AS p, generate_subscripts(ps, 1) - 1 AS pos FROM cut),"
        f" labelled AS (SELECT *, {label('p')} AS label FROM rows_),"
        " paragraphs AS (SELECT doc_id, pos, p, lower(p) AS low, label, coalesce(last_value(label"
        " IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY pos ROWS UNBOUNDED PRECEDING),"
        " 'required') AS state FROM labelled)"
    )


def skills(source: str = "postings", text: str = "description") -> str:
    """CTE ``skills(doc_id, req, opt, tools)`` with sorted lists, for every row of the source."""
    return ", ".join(
        [
            VOCABULARY,
            TOOLS,
            paragraphs(source, text),
            f"found AS (SELECT DISTINCT p.doc_id, p.state, v.skill FROM paragraphs p"
            f" JOIN vocabulary v ON {HIT})",
            "best AS (SELECT doc_id, skill, bool_or(state = 'required') AS r FROM found GROUP BY ALL)",
            "promoted AS (SELECT doc_id, skill, r OR NOT bool_or(r) OVER (PARTITION BY doc_id) AS r"
            " FROM best)",
            "lists AS (SELECT doc_id,"
            " list(skill ORDER BY skill) FILTER (r) AS req,"
            " list(skill ORDER BY skill) FILTER (NOT r) AS opt,"
            " list(skill ORDER BY skill) FILTER (skill IN (SELECT tool FROM tools)) AS tools"
            " FROM promoted GROUP BY doc_id)",
            f"skills AS (SELECT s.doc_id, coalesce(req, []) AS req, coalesce(opt, []) AS opt,"
            f" coalesce(tools, []) AS tools FROM {source} s LEFT JOIN lists l ON s.doc_id = l.doc_id)",
        ]
    )


def joined(x: str) -> str:
    return f"coalesce(array_to_string({x}, '|'), '')"


TITLE_LOW = strip(
    "regexp_replace(regexp_replace(lower(raw_title), '\\(.*?\\)', '', 'g'), '\\s+', ' ', 'g')"
)
NORMALIZED_TITLE = (
    f"CASE WHEN raw_title IS NULL OR raw_title = '' THEN 'Unknown' ELSE coalesce("
    f"{first_hit(TITLE_LOW, rules.TITLE_RULES)}, {strip('raw_title')}) END"
)
KEYWORDS = (
    "list_filter(["
    + ", ".join(
        f"CASE WHEN regexp_matches(raw_title, '(?i)\\b{escape(k)}\\b') THEN {quote(k)} END"
        if len(k) <= rules.TITLE_KEYWORD_BOUNDED_UP_TO
        else f"CASE WHEN contains(lower(raw_title), {quote(k.lower())}) THEN {quote(k)} END"
        for k in rules.TITLE_KEYWORDS
    )
    + "], lambda k: k IS NOT NULL)"
)
WORK_MODE = first_hit("lower(description || ' ' || raw_location)", rules.WORK_MODE_RULES, "'Unknown'")
EMPLOYMENT = (
    f"coalesce({first_hit('lower(employment_type_raw)', rules.EMPLOYMENT_RULES)},"
    f" {first_hit('lower(description)', rules.EMPLOYMENT_RULES)}, 'Unknown')"
)
YEARS = "coalesce(" + ", ".join(
    f"TRY_CAST(nullif(regexp_extract(description, '(?i){p}', 1), '') AS INTEGER)"
    for p in rules.EXPERIENCE_PATTERNS
) + ")"
SENTENCE = strip(
    f"nullif(regexp_extract(description, '(?i)[^\\n.]*(?:{rules.YEARS_MENTION})[^\\n.]*[.\\n]?', 0), '')"
)


def level_of_rank(rank: str) -> str:
    return "CASE " + rank + " " + " ".join(
        f"WHEN {i} THEN {quote(v)}" for i, v in enumerate(rules.SENIORITY_LEVELS)
    ) + " ELSE 'Unknown' END"


def rank_of_level(level: str) -> str:
    return "CASE " + level + " " + " ".join(
        f"WHEN {quote(v)} THEN {i}" for i, v in enumerate(rules.SENIORITY_LEVELS)
    ) + " END"


def rank_of(text: str, table) -> str:
    """Highest rank among the rules that hit, as a maximum over all of them."""
    ranks = {v: i for i, v in enumerate(rules.SENIORITY_LEVELS)}
    return "greatest(" + ", ".join(
        f"CASE WHEN contains({text}, {quote(k)}) THEN {ranks[v]} END" for k, v in table
    ) + ")"


def years_rank(years: str) -> str:
    return "CASE " + " ".join(
        f"WHEN {years} >= {low} AND {years} < {high} THEN {i}"
        for i, (low, high, _) in enumerate(rules.SENIORITY_YEARS)
    ) + " END"


SENIORITY = level_of_rank(
    f"greatest({rank_of('lower(raw_title)', rules.SENIORITY_TITLE)},"
    f" {rank_of('lower(description)', rules.SENIORITY_VERBS)}, {years_rank(YEARS)})"
)
STATES = "MAP {" + ", ".join(f"{quote(k)}: {quote(v)}" for k, v in rules.US_STATES) + "}"


def state(x: str) -> str:
    return f"({STATES})[upper({x})]"


COUNTRIES = "(" + ", ".join(map(quote, rules.COUNTRIES)) + ")"
# CTE place(doc_id, city, region, country)
PLACE = f"""
parts AS (SELECT doc_id, {strip('raw_location')} AS loc,
  list_filter(list_transform(string_split(raw_location, ','), lambda x: {strip('x')}),
  lambda x: x <> '') AS ps FROM postings),
kinds AS (SELECT doc_id, ps, CASE WHEN loc = '' OR upper(loc) = 'N/A' THEN 0
  WHEN regexp_matches(loc, '(?i)^remote\\b') THEN -1 ELSE least(len(ps), 3) END AS kind,
  {state('ps[1]')} AS s1, {state('ps[2]')} AS s2 FROM parts),
place AS (SELECT doc_id,
  CASE WHEN kind >= 2 THEN ps[1] END AS city,
  CASE kind WHEN 1 THEN CASE WHEN lower(ps[1]) NOT IN {COUNTRIES} THEN s1 END
    WHEN 2 THEN CASE WHEN s2 IS NOT NULL THEN s2 WHEN lower(ps[2]) NOT IN {COUNTRIES} THEN ps[2] END
    WHEN 3 THEN coalesce(s2, ps[2]) END AS region,
  CASE kind WHEN -1 THEN 'Remote'
    WHEN 1 THEN CASE WHEN lower(ps[1]) NOT IN {COUNTRIES} AND s1 IS NOT NULL
      THEN 'United States' ELSE ps[1] END
    WHEN 2 THEN CASE WHEN s2 IS NOT NULL THEN 'United States'
      WHEN lower(ps[2]) IN {COUNTRIES} THEN ps[2] END
    WHEN 3 THEN ps[3] END AS country
  FROM kinds)"""
UNIT_DAYS = "CASE lower(regexp_extract(date_posted_raw, '(?i)" + rules.AGO_PATTERN + "', 2)) " + " ".join(
    f"WHEN {quote(u)} THEN {d}" for u, d in rules.AGO_UNIT_DAYS
) + " END"
POSTED_DAY = f"""
CAST(CASE WHEN upper({strip('date_posted_raw')}) = 'N/A' THEN NULL
 WHEN {UNIT_DAYS} IS NOT NULL THEN CAST(scrape_timestamp AS DATE) - CAST(CAST(regexp_extract(
   date_posted_raw, '(?i){rules.AGO_PATTERN}', 1) AS INTEGER) * {UNIT_DAYS} AS INTEGER)
 ELSE coalesce(CAST(try_strptime(date_posted_raw, '%Y-%m-%d') AS DATE),
   CAST(try_strptime(date_posted_raw, '%B %d, %Y') AS DATE),
   CAST(try_strptime(date_posted_raw, '%b %d, %Y') AS DATE),
   CAST(try_strptime(date_posted_raw, '%m/%d/%Y') AS DATE)) END AS VARCHAR)"""

SIGNALS = values(
    [(i, role, k) for i, (role, ks) in enumerate(rules.ROLE_SIGNALS) for k in ks],
    "priority, role, keyword",
    "signals",
)
ROLE_TOOLS = values(
    [(role, t) for role, ts in rules.ROLE_TOOLS.items() for t in ts], "role, tool", "role_tools"
)


def scores(tools: str) -> str:
    """CTE ``scores(doc_id, role, priority, score)``; ``tools`` gives ``doc_id, tools``."""
    start = ", ".join(
        f"nullif(instr(d, {quote(m)}), 0)" for m in rules.OPTIONAL_MARKERS
    )
    return f"""
{SIGNALS}, {ROLE_TOOLS}, tool_lists AS ({tools}),
lowered AS (SELECT doc_id, lower(coalesce(raw_title, '')) AS t, lower(coalesce(description, '')) AS d
  FROM postings),
split_ AS (SELECT doc_id, t, d, least({start}, length(d) + 1) AS s FROM lowered),
parts_ AS (SELECT doc_id, t, substring(d, 1, s - 1) AS core, substring(d, s) AS opt FROM split_),
word_scores AS (SELECT p.doc_id, g.priority, g.role,
  sum(CASE WHEN contains(t, keyword) THEN 3.0 ELSE 0 END
   + CASE WHEN contains(core, keyword) THEN 2.0 ELSE 0 END
   + CASE WHEN contains(opt, keyword) THEN 0.5 ELSE 0 END) AS score
  FROM parts_ p CROSS JOIN signals g GROUP BY ALL),
tool_scores AS (SELECT l.doc_id, r.role, count(*) AS n FROM (SELECT doc_id, unnest(tools) AS tool
  FROM tool_lists) l JOIN role_tools r ON l.tool = r.tool GROUP BY ALL),
scores AS (SELECT w.doc_id, w.role, w.priority, CAST(w.score + coalesce(n, 0) AS DOUBLE) AS score
  FROM word_scores w LEFT JOIN tool_scores t ON w.doc_id = t.doc_id AND w.role = t.role)"""


ROLE = (
    "roles AS (SELECT doc_id, CASE WHEN max(score) > 0 THEN arg_max(role, score * 100 - priority)"
    " ELSE 'Unknown' END AS role_type FROM scores GROUP BY doc_id)"
)
# CTEs up to parsed: one row per posting that passes both gates
PARSED = ", ".join(
    [
        skills(),
        scores("SELECT doc_id, tools FROM skills"),
        ROLE,
        PLACE,
        f"""parsed AS (SELECT p.doc_id,
  substring(sha256(lower({strip('job_url')})), 1, 16) AS job_id,
  nullif(company, 'N/A') AS company, raw_title, {NORMALIZED_TITLE} AS normalized_title,
  {joined(KEYWORDS)} AS title_keywords, role_type, {SENIORITY} AS seniority_level,
  req, opt, tools, {YEARS} AS min_years_experience, {SENTENCE} AS experience_text,
  {EMPLOYMENT} AS employment_type, {WORK_MODE} AS work_mode, city, region, country,
  nullif(date_posted_raw, 'N/A') AS date_posted_raw, {POSTED_DAY} AS date_posted_normalized,
  description, job_url, scrape_timestamp
  FROM postings p JOIN skills s ON p.doc_id = s.doc_id JOIN roles r ON p.doc_id = r.doc_id
  JOIN place l ON p.doc_id = l.doc_id
  WHERE length({strip('description')}) >= 50 AND len(req) + len(opt) > 0)""",
    ]
)


def over_parsed(select: str, *more: str) -> str:
    return with_postings(select, PARSED, *more)
