"""One literal row per edge case; expected values were derived by hand."""

import json
import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from hirelens.functions import dates, embedded_json, location, matching, roles, skills, text, title


def evaluate(spark, rows, types, expression):
    """Run one expression over rows of literals; columns are named a, b, c."""
    names = "abc"[: len(types)]
    schema = ", ".join(f"{n} {t}" for n, t in zip(names, types))
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"i int, {schema}")
    out = df.select("i", expression(*[F.col(n) for n in names]).alias("v")).orderBy("i").collect()
    return [r["v"] for r in out]


def one(spark, values, expression):
    return evaluate(spark, [(v,) for v in values], ["string"], expression)


def test_strip(spark):
    assert one(spark, ["\tX \n", " a b ", "", None], text.strip) == ["X", "a b", "", None]


def test_normalize_title(spark):
    assert one(
        spark,
        [
            "Senior Staff Data Scientist - NLP",
            "Seamless Commerce Manager",
            "Chef (Data Scientist)",
            "Machine   Learning Engineer (L4)",
            "ML/AI Fraud Data Scientist",
            None,
            "",
            " Baker ",
        ],
        title.normalize_title,
    ) == [
        "Data Scientist",
        "Machine Learning Engineer",
        "Chef (Data Scientist)",
        "Machine Learning Engineer",
        "Data Scientist",
        "Unknown",
        "Unknown",
        "Baker",
    ]


def test_title_keywords(spark):
    assert one(
        spark,
        ["International Sales Lead", "Generative AI Product Manager", None, "ai/ml (l5)", "maid"],
        title.title_keywords,
    ) == [["Lead", "Intern"], ["AI", "Generative AI", "Product"], [], ["ML", "AI", "L5"], []]


def test_find_skills(spark):
    assert one(
        spark,
        [
            "We use R&D and JavaScript.",
            "Drag and drop storage, digital archive",
            "c#, C++ and py\nr",
            "",
            None,
        ],
        skills.find_skills,
    ) == [
        ["Java", "JavaScript", "R"],
        ["Git", "Hive", "RAG"],
        ["C#", "C++", "Python", "R"],
        [],
        [],
    ]


def test_find_skills_bounded(spark):
    found = one(
        spark,
        ["storage and digital JavaScript", "Java, RAG"],
        lambda c: skills.find_skills(c, bounded_only=True),
    )
    assert found == [["JavaScript"], ["Java", "RAG"]]


def test_bounded_groups_keeps_overlapping_needles_apart(spark):
    groups = matching.bounded_groups(["c", "c+", "go"])
    assert len(groups) == 2
    vocabulary = [("c", "C"), ("c+", "C plus"), ("go", "Go")]
    assert one(spark, ["c+ go"], lambda c: skills.find_skills(c, vocabulary)) == [
        ["C", "C plus", "Go"]
    ]


@pytest.mark.parametrize(
    "description, required, optional, tools",
    [
        (
            "Requirements\nPython\n\nNice to have\nDocker\n\nAbout us\nWe use Kafka",
            ["Python"],
            ["Docker", "Kafka"],
            ["Docker", "Kafka", "Python"],
        ),
        ("Preferred qualifications: Docker", ["Docker"], [], ["Docker"]),
        ("Nice to have: Docker", ["Docker"], [], ["Docker"]),
        ("Bonus\nSpark\n\nRequirements\nSQL and spark", ["Apache Spark", "SQL"], [], ["Apache Spark", "SQL"]),
        ("Requirements\x03\nSQL\x02\n\nBonus\nKafka", ["SQL"], ["Kafka"], ["Kafka", "SQL"]),
        ("Bonus: deep learning\nRequired: NLP\n\n", ["NLP"], ["Deep Learning"], []),
        ("nothing", [], [], []),
        ("", [], [], []),
        (None, [], [], []),
    ],
)
def test_extract_skills(spark, description, required, optional, tools):
    (v,) = one(spark, [description], skills.extract_skills)
    assert (v.skills_required, v.skills_optional, v.tools_frameworks) == (required, optional, tools)


def test_split_paragraphs(spark):
    assert one(spark, ["a\nb\n\n\nc\n- d\n• e\n"], skills.split_paragraphs) == [
        ["a\nb", "c", "- d", "• e\n"]
    ]


def test_section_label_reads_the_first_150_characters(spark):
    assert one(
        spark,
        ["x" * 140 + " required", "x" * 150 + "required", "What you’ll need", "a plus", "other"],
        skills.section_label,
    ) == ["required", None, "required", "optional", None]


@pytest.mark.parametrize(
    "description, years, sentence",
    [
        ("5+ years of relevant experience", None, "5+ years of relevant experience"),
        ("3-5 years of experience", 3, "3-5 years of experience"),
        ("3–5 years of experience", 5, "3–5 years of experience"),
        ("at least 4 years", 4, "at least 4 years"),
        ("minimum of 3 years", None, "minimum of 3 years"),
        ("Experience: 7 yrs", 7, "Experience: 7 yrs"),
        ("Hi there. You have 2 years of experience. Ok.", 2, "You have 2 years of experience."),
        ("First line\nwith 10\nyears in it. End", None, "with 10\nyears in it."),
        ("one 2 years and 3 years more, 4 days", None, "one 2 years and 3 years more, 4 days"),
        ("none", None, None),
        ("", None, None),
        (None, None, None),
    ],
)
def test_experience(spark, description, years, sentence):
    (v,) = one(spark, [description], roles.experience)
    assert (v.min_years_experience, v.experience_text) == (years, sentence)


def test_seniority(spark):
    rows = [
        ("International Analyst", "", None, "Junior"),
        ("Data Scientist", "data-driven culture", None, "Senior"),
        ("Junior Analyst", "", 9, "Staff/Lead"),
        ("Analyst", "", None, "Unknown"),
        (None, None, 3, "Mid"),
        ("Analyst", "", 100, "Unknown"),
        ("Sr. L3", "", None, "Senior"),
    ]
    got = evaluate(spark, [r[:3] for r in rows], ["string", "string", "int"], roles.seniority)
    assert got == [r[3] for r in rows]


def test_role_type(spark):
    rows = [
        ("", "llm publish", [], "GenAI / LLM Engineer"),
        ("", "nothing here", [], "Unknown"),
        (None, None, None, "Unknown"),
        ("Publishing", "llm", [], "Research Scientist"),
        ("", "publish plus llm, genai", [], "Research Scientist"),
        ("", "plus publish llm genai", [], "GenAI / LLM Engineer"),
        ("", "kpi", ["Docker", "Kubernetes", "MLflow"], "Machine Learning Engineer"),
    ]
    got = evaluate(
        spark, [r[:3] for r in rows], ["string", "string", "array<string>"], roles.role_type
    )
    assert got == [r[3] for r in rows]


def test_employment_type(spark):
    rows = [
        ("fill in the template", None, "Temporary"),
        ("contract", "Full-time", "Full-time"),
        (None, None, "Unknown"),
        ("", "Internship", "Internship"),
    ]
    got = evaluate(spark, [r[:2] for r in rows], ["string", "string"], roles.employment_type)
    assert got == [r[2] for r in rows]


def test_work_mode(spark):
    rows = [
        ("Hybrid or remote", None, "Remote"),
        ("we are on", "site five", "Onsite"),
        (None, "Hybrid", "Hybrid"),
        (None, None, "Unknown"),
    ]
    got = evaluate(spark, [r[:2] for r in rows], ["string", "string"], roles.work_mode)
    assert got == [r[2] for r in rows]


def test_parse_location(spark):
    rows = {
        "Toronto, CA": ("Toronto", "California", "United States"),
        "IN": (None, "Indiana", "United States"),
        "Remote - US": (None, None, "Remote"),
        "Remotely, TX": ("Remotely", "Texas", "United States"),
        "New York, NY, United States": ("New York", "New York", "United States"),
        "Bengaluru, Karnataka, India": ("Bengaluru", "Karnataka", "India"),
        "A, B, C, D": ("A", "B", "C"),
        "Paris": (None, None, "Paris"),
        "uk": (None, None, "uk"),
        "Lyon, France": ("Lyon", None, "France"),
        "Lyon, Rhone": ("Lyon", "Rhone", None),
        ", ,": (None, None, None),
        " n/a ": (None, None, None),
        "": (None, None, None),
        None: (None, None, None),
    }
    assert [tuple(v) for v in one(spark, list(rows), location.parse_location)] == list(rows.values())


def test_normalize_date(spark):
    rows = {
        "3 weeks ago": "2026-01-26",
        "2 months ago": "2025-12-18",
        "1 year ago": "2025-02-16",
        "5 hours ago": "2026-02-16",
        "30+ days ago": None,
        "just now": None,
        " n/a ": None,
        "Feb 7, 2026": "2026-02-07",
        "February 7, 2026": "2026-02-07",
        "02/07/2026": "2026-02-07",
        "2026-02-07": "2026-02-07",
        "99999999999 years ago": None,
        "5000 years ago": None,
        "": None,
        None: None,
    }
    got = one(spark, list(rows), lambda c: dates.normalize_date(c, F.lit("2026-02-16T20:31:07.5")))
    assert [v and v.isoformat() for v in got] == list(rows.values())
    assert all(v is None or isinstance(v, dt.date) for v in got)


def test_hashes(spark):
    def sha(s):
        return hashlib.sha256(s.encode()).hexdigest()

    assert one(spark, [None, "  ", " x ", "é"], text.hash_content) == [
        None,
        None,
        sha("x"),
        sha("é"),
    ]
    assert one(spark, [" x "], lambda c: text.hash_content(c, "md5")) == [
        hashlib.md5(b"x").hexdigest()
    ]
    with pytest.raises(ValueError):
        text.hash_content(F.col("a"), "crc")
    assert one(spark, [" HTTP://A "], text.job_id16) == [sha("http://a")[:16]]
    assert one(spark, [" HTTP://A "], text.hash_job_url) == [sha("HTTP://A")]


def test_urls(spark):
    assert one(
        spark,
        ["https://c.example/x/?t=1", "", None, "https://c.example/x/about?y", "https://c.example/x"],
        text.company_about_url,
    ) == [
        "https://c.example/x/about/",
        "",
        "",
        "https://c.example/x/about",
        "https://c.example/x/about/",
    ]
    assert one(spark, ["Data Scientist/ML"], text.keyword_slug) == ["data_scientist_ml"]
    assert one(spark, ["N/A", "n/a", None], text.na_to_null) == [None, "n/a", None]


def test_first_block(spark):
    rows = {
        'x={"a":[1,2]};y={}': '{"a":[1,2]}',
        'x={"jobPosting":"}"}': '{"jobPosting":"}',
        "f(x)[1]": "[1]",
        "no bracket": None,
        "{ open": None,
        "} {a}": "{a}",
        "{]": "{]",
        None: None,
    }
    assert one(spark, list(rows), embedded_json.first_block) == list(rows.values())


def test_json_valid(spark):
    """As the standard library reads it: repeated keys and NaN are fine, anything behind is not."""
    texts = ['{"a":1}', '{"a":1,"a":2}', "[NaN]", "{a}", "3", '"x"', "", "  ", '{"a":1} x', "1],[2", "1,2"]
    texts += ['{"a":[1,2,{"b":null}]}', '{"a":}', "[1,]", "{'a':1}", "nul", "null", "01", '{"a":"b\nc"}', "[1"]
    texts += ['"a', '{"a":1}}', ' {"x": -Infinity} ', '1],"end"]', '"end"', "// c\n1"]

    def valid(text):
        try:
            json.loads(text)
        except ValueError:
            return False
        return True

    assert one(spark, [*texts, None], embedded_json.json_valid) == [*map(valid, texts), False]
