"""Inputs of the registered queries: the test tables and what is derived from them.

``documents`` hardly names a skill, so postings are built around its texts: title, company,
place, date and section headings are picked by ``doc_id``, and the whole text is the body. The
picking expressions are plain SQL that Spark and DuckDB both read, so that the SQL the queries are
checked against starts from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens import rules
from hirelens.functions.text import hash_job_url, strip_query
from hirelens.operators.extract import extract_company_pages
from hirelens.operators.postings import parse_postings
from hirelens.operators.records import build_raw_company, build_raw_job
from hirelens.session import new_path

TITLES = [
    "Senior Data Scientist (Remote)",
    "Machine Learning Engineer L4",
    "MLE - Ranking",
    "Research Scientist, NLP",
    "GenAI Engineer",
    "Staff Data Engineer",
    "Junior Data Analyst",
    "Analytics Engineer",
    "Chef (Data Scientist)",
    "International Sales Lead",
    None,
]
COMPANIES = ["Acme", "Globex", "Initech", "N/A", "Umbrella", "Hooli", "Stark"]
LOCATIONS = [
    "Austin, TX",
    "Bengaluru, Karnataka, India",
    "United States",
    "Remote - US",
    "Toronto, CA",
    "Paris",
    "Lyon, France",
    "New York, NY, United States",
    "A, B, C, D",
    "IN",
    ", ,",
    "N/A",
    "Remotely, tx",
]
POSTED = [
    "3 weeks ago",
    "2 months ago",
    "1 year ago",
    "5 hours ago",
    "4 days ago",
    "N/A",
    "30+ days ago",
    "Feb 7, 2026",
    "02/07/2026",
]
REQUIRED = [
    "Python, SQL and Spark",
    "PyTorch or TensorFlow, Kubernetes",
    "Tableau, Excel, A/B testing",
    "LLM fine-tuning, LangChain, Hugging Face transformers",
    "C++ and Go microservice work, Docker",
]
OPTIONAL = ["Airflow and dbt", "AWS or GCP, Kafka", "R&D mindset"]
YEARS = [
    "3+ years of experience.",
    "5-7 years experience in the field.",
    "At least 2 years.",
    "Minimum of 3 years.",
    "10 yrs of experience.",
    "Experience: 1 years.",
    "No experience needed.",
    "4+ years of relevant experience.",
]
SALARIES = ["$120,000 - $150,000 a year", "€55k per year", "£40 per hour", "USD 9,500 / month"]
EMPLOYMENT = ["Full-time", "Contract", None, "Internship"]


def pick(values: list[str | None], key: str = "doc_id") -> str:
    """SQL for ``values[key mod length]``."""
    arms = " ".join(
        f"WHEN {i} THEN " + ("NULL" if v is None else f"'{v}'") for i, v in enumerate(values)
    )
    return f"CASE CAST({key} % {len(values)} AS INT) {arms} END"


# Rows 8 and 9 of every ten repeat the job of rows 0 and 1 in another run.
JOB_NO = "CASE WHEN doc_id % 10 >= 8 THEN doc_id - 8 ELSE doc_id END"
POSTING_COLUMNS = {
    "doc_id": "doc_id",
    "job_url": f"'https://jobs.example/view/' || CAST({JOB_NO} AS VARCHAR(20))"
    " || '?trk=' || CAST(doc_id AS VARCHAR(20))",
    "company_url": "'https://co.example/c/' || CAST(doc_id % 37 AS VARCHAR(20)) || '?x=1'",
    "raw_title": pick(TITLES),
    "company": pick(COMPANIES),
    "raw_location": pick(LOCATIONS),
    "date_posted_raw": pick(POSTED),
    "scrape_timestamp": "'2026-02-' || CAST(16 + doc_id % 5 AS VARCHAR(20)) || 'T20:31:07'",
    "salary_raw": f"CASE WHEN doc_id % 3 <> 0 THEN {pick(SALARIES)} END",
    "applicant_count_raw": "CASE WHEN doc_id % 4 <> 0 THEN"
    " CAST(doc_id % 200 AS VARCHAR(20)) || ' applicants' END",
    "employment_type_raw": pick(EMPLOYMENT, "(doc_id % 97)"),
    "description": "CASE WHEN doc_id % 17 = 16 THEN 'Apply with us today' ELSE"
    f" 'Requirements' || chr(10) || {pick(REQUIRED)} || chr(10) || chr(10) || 'Nice to have'"
    f" || chr(10) || {pick(OPTIONAL)} || chr(10) || {pick(YEARS)} || chr(10) || chr(10) || text"
    " END",
    "text": "text",
    "lang": "lang",
}
POSTINGS_SQL = (
    "SELECT " + ", ".join(f"{sql} AS {name}" for name, sql in POSTING_COLUMNS.items())
    + " FROM documents"
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table. Tables of texts and pages are dealt to tasks evenly, see ``spread``: what is done
    with them costs far more than moving them."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(df) if name in ("documents", "pages", "conversations") else df


def postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One posting per row of ``documents``."""
    return as_postings(table(spark, sf_dir, "documents"))


def as_postings(docs: DataFrame) -> DataFrame:
    return docs.selectExpr(*[f"{sql} AS {name}" for name, sql in POSTING_COLUMNS.items()])


def _escape(c):
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.replace(c, F.lit(char), F.lit(entity))
    return c


def job_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A saved job page per posting: ``doc_id, url, html``. Every 13th is missing, every 11th has
    its description in an unmarked block."""
    p = postings(spark, sf_dir)
    body = F.concat(
        F.lit("<p>"), F.replace(_escape(F.col("description")), F.lit("\n"), F.lit("<br>")), F.lit("</p>")
    )
    text_class = F.when(F.col("doc_id") % 11 == 10, "other").otherwise(
        "show-more-less-html__markup clamp"
    )
    salary = F.when(
        F.col("salary_raw").isNotNull(),
        F.concat(F.lit('<span class="top-card-layout__salary-info"> '), _escape(F.col("salary_raw")), F.lit("</span>")),
    )
    applicants = F.when(
        F.col("applicant_count_raw").isNotNull(),
        F.concat(
            F.lit('<figcaption class="num-applicants__caption">\n'),
            F.col("applicant_count_raw"),
            F.lit("</figcaption>"),
        ),
    )
    criteria = F.when(
        F.col("employment_type_raw").isNotNull(),
        F.concat(
            F.lit(
                '<ul><li class="description__job-criteria-item">'
                '<h3 class="description__job-criteria-subheader">Employment type</h3>'
                '<span class="description__job-criteria-text">'
            ),
            F.col("employment_type_raw"),
            F.lit(
                '</span></li><li class="description__job-criteria-item">'
                '<h3 class="description__job-criteria-subheader"> Industries </h3>'
                '<span class="description__job-criteria-text">Old</span></li>'
                '<li class="description__job-criteria-item">'
                '<h3 class="description__job-criteria-subheader">Industries</h3>'
                '<span class="description__job-criteria-text">Software &amp; Data</span></li></ul>'
            ),
        ),
    )
    scripts = F.concat(
        F.lit('<script type="application/ld+json">{broken</script><script type="application/ld+json"> {"n":'),
        F.col("doc_id"),
        F.lit('} </script><script>var x={"jobPosting":['),
        F.col("doc_id"),
        F.lit(',{"a":1}]};go();</script>'),
    )
    header = F.concat(
        F.lit('<section class="top-card-layout"><h1>'),
        _escape(F.coalesce("raw_title", F.lit(""))),
        F.lit('</h1><span class="topcard__flavor--bullet">'),
        _escape(F.col("raw_location")),
        F.lit("</span>"),
    )
    html = F.concat(
        F.lit("<!DOCTYPE html><html><body>"),
        header,
        F.coalesce(salary, F.lit("")),
        F.coalesce(applicants, F.lit("")),
        F.lit("</section>"),
        F.lit('<div class="'),
        text_class,
        F.lit('">'),
        body,
        F.lit("</div>"),
        F.coalesce(criteria, F.lit("")),
        F.when(F.col("doc_id") % 5 != 4, scripts).otherwise(""),
        F.lit("</body></html>"),
    )
    return p.select(
        "doc_id", F.col("job_url").alias("url"), F.when(F.col("doc_id") % 13 != 12, html).alias("html")
    )


def listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing pages of 25 cards: ``page_id, html``."""
    p = postings(spark, sf_dir)
    card = F.concat(
        F.lit('<li><div class="base-card"><a class="base-card__full-link x" href="'),
        F.col("job_url"),
        F.lit('">open</a><h3 class="base-search-card__title">\n '),
        _escape(F.coalesce("raw_title", F.lit(""))),
        F.lit('</h3><h4 class="base-search-card__subtitle"><a class="hidden-nested-link" href="'),
        F.col("company_url"),
        F.lit('">'),
        F.col("company"),
        F.lit('</a></h4><span class="job-search-card__location">'),
        F.col("raw_location"),
        F.lit('</span><time class="job-search-card__listdate" datetime="2026-01-01">'),
        F.col("date_posted_raw"),
        F.lit("</time></div></li>"),
    )
    cards = p.groupBy(F.expr("doc_id div 25").alias("page_id")).agg(
        F.sort_array(F.collect_list(F.struct("doc_id", card.alias("card")))).alias("cards")
    )
    pages = cards.select(
        "page_id",
        F.concat(F.lit("<ul>"), F.array_join(F.expr("cards.card"), "\n"), F.lit("</ul>")).alias("html"),
    )
    # so few small pages would be coalesced into one task, and be parsed by one core
    return pages.repartition(spark.sparkContext.defaultParallelism, "page_id")


def company_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A saved about page per supplier: ``s_suppkey, url, html``."""
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    joined = s.join(n, s["s_nationkey"] == n["n_nationkey"])
    html = F.concat(
        F.lit('<section data-test-id="about-us"><p>About '),
        F.col("s_name"),
        F.lit("</p><p>We hire.</p></section><dl><dt>Website</dt><dd>http://old</dd>"),
        F.when(
            F.col("s_suppkey") % 3 != 0,
            F.concat(F.lit("<dt>Industry</dt><p>x</p><dd>Industry "), F.col("s_nationkey"), F.lit("</dd>")),
        ).otherwise(""),
        F.lit("<dt>Company size</dt><dd>"),
        F.col("s_suppkey"),
        F.lit(" employees</dd><dt>Headquarters</dt><dd>"),
        F.col("n_name"),
        F.lit("</dd><dt>Organization type</dt><dd>Private</dd><dt>Your website</dt><dd>http://s"),
        F.col("s_suppkey"),
        F.lit('.example</dd></dl><div data-test-id="about-us__industry">Fallback</div>'),
    )
    return joined.select(
        "s_suppkey",
        "s_name",
        F.concat(F.lit("https://co.example/c/"), F.col("s_suppkey"), F.lit("?x=1")).alias("url"),
        html.alias("html"),
    )


# field -> (its selectors, the words its text begins with)
SELECTED = {
    "description": (rules.DESCRIPTION_SELECTORS, "A description that is long enough to count as one, of posting"),
    "location": (rules.LOCATION_SELECTORS, "Place"),
    "insight": (rules.INSIGHT_SELECTORS, "Insight"),
    "salary": (rules.SALARY_SELECTORS, "Salary"),
    "applicant_count": (rules.APPLICANT_SELECTORS, "Applicants"),
    "easy_apply_flag": (rules.EASY_APPLY_SELECTORS, "Easy"),
    "remote_label": (rules.REMOTE_LABEL_SELECTORS, "Remote"),
    "posted_by": (rules.POSTED_BY_SELECTORS, "Recruiter"),
}
CRITERIA_LABELS = ["Employment type", " Seniority level\n", "Industries", "Job function"]


def selected_element(name: str) -> str:
    """SQL of the one element of a field on the page of a document: the selector is picked by
    ``doc_id``, so the pages between them hit every one."""
    selectors, words = SELECTED[name]
    arms = " ".join(
        f"WHEN {i} THEN '<{tag} {attribute}=\"{value}\">{words} ' || CAST(doc_id AS VARCHAR(20)) || '</{tag}>'"
        for i, (tag, attribute, value) in enumerate(selectors)
    )
    return f"CASE CAST(doc_id % {len(selectors)} AS INT) {arms} END"


def selected_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A job page per document with every field there is: ``doc_id, html``."""
    (item, _, item_class), (head, _, head_class), (value, _, value_class) = (
        rules.CRITERIA_ITEM, rules.CRITERIA_HEADER, rules.CRITERIA_VALUE,
    )
    criteria = [
        f"'<{item} class=\"{item_class}\"><{head} class=\"{head_class}\">{label}</{head}>"
        f"<{value} class=\"{value_class}\">{label.strip()} ' || CAST(doc_id AS VARCHAR(20)) || '</{value}></{item}>'"
        for label in CRITERIA_LABELS
    ]
    html = " || ".join([*map(selected_element, SELECTED), *criteria])
    return table(spark, sf_dir, "documents").selectExpr("doc_id", f"{html} AS html")


def full_company_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An about page per supplier with every fact and, by the key, one of the about selectors."""
    key = "CAST(s_suppkey AS VARCHAR(20))"
    arms = " ".join(
        f"WHEN {i} THEN '<{tag} {attribute}=\"{value}\">About supplier ' || {key} || '</{tag}>'"
        for i, (tag, attribute, value) in enumerate(rules.ABOUT_SELECTORS)
    )
    facts = [
        f"'<dt>{word.capitalize()}</dt><dd>{name} ' || {key} || '</dd>'" for word, name in rules.COMPANY_FACTS
    ]
    about = f"CASE CAST(s_suppkey % {len(rules.ABOUT_SELECTORS)} AS INT) {arms} END"
    html = f"{about} || '<dl>' || " + " || ".join(facts) + " || '</dl>'"
    return table(spark, sf_dir, "supplier").selectExpr("s_suppkey", f"{html} AS html")


def cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing cards with ``page``, ``position`` and the fields that the job page would give."""
    p = postings(spark, sf_dir)
    return p.withColumns(
        {
            "page": F.expr("doc_id div 25"),
            "position": F.expr("CAST(doc_id % 25 AS INT)"),
            "job_url": strip_query(F.col("job_url")),
            "company_url": strip_query(F.col("company_url")),
            "date_posted_attr": F.lit(None).cast("string"),
            "job_id_raw": hash_job_url(strip_query(F.col("job_url"))),
        }
    )


def raw_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested raw job records, one per posting."""
    return build_raw_job(
        cards(spark, sf_dir), F.col("scrape_timestamp"), "Data Scientist/ML", "worldwide"
    )


def raw_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested company records: every company page, seen in three runs."""
    found = extract_company_pages(company_pages(spark, sf_dir), ["s_suppkey", "s_name", "url"])
    runs = F.array(*[F.lit(f"2026-02-{day}T20:31:07") for day in (16, 18, 20)])
    seen = found.filter("success").select(
        "*", F.explode(runs).alias("run_ts"), strip_query(F.col("url")).alias("company_url")
    )
    return build_raw_company(
        seen.withColumn("company_name", F.col("s_name")), F.col("run_ts")
    )


def spread(df: DataFrame) -> DataFrame:
    """The rows of a scan dealt to tasks evenly. Splits of a file are no measure of them: a row group
    goes to the task of one split as a whole and leaves its other splits empty, so a few tasks would
    parse nearly all rows."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(2 * cores, 8 * df.rdd.getNumPartitions()))


def parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed postings with ``doc_id``."""
    scan = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return parse_postings(as_postings(spread(scan)))


_PARSED_TABLES: dict[tuple, str] = {}


def parsed_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parsed postings as a table in the shared folder, written once per application.

    Reports read their input several times; they are meant to run on the written dataset, not to
    parse anew each time.
    """
    files = spark.read.format("binaryFile").load(f"{sf_dir}/documents.parquet")
    state = files.select(F.sum("length"), F.max("modificationTime"), F.count(F.lit(1))).first()
    key = (spark.sparkContext.applicationId, sf_dir, *state)  # changed files are parsed anew
    if key not in _PARSED_TABLES:
        path = new_path(spark, "parsed-postings")
        parsed(spark, sf_dir).drop("text").write.parquet(path)
        _PARSED_TABLES[key] = path
    return spark.read.parquet(_PARSED_TABLES[key])
