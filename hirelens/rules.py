"""Rule tables: every vocabulary the parsers and extractors use.

All of them are plain rows. Each operator takes its table as an argument and these are only
the defaults. Order is meaningful: in an ordered table the first hit wins, and ties go to the
earlier row.
"""

from __future__ import annotations

# --------------------------------------------------------------------------------------
# FIXED VALUES. Everything from here to the end of the file is data that has to be exactly
# this for results to be right: vocabularies, look-up tables, selectors, patterns, versions.
# --------------------------------------------------------------------------------------

RAW_VERSION = "1.0.0"
SCRAPER_VERSION = "1.0.0"
PARSED_SCHEMA_VERSION = "0.2"
DATASET_VERSION = "v0.2"
DEFAULT_SOURCE = "linkedin"

UNKNOWN = "Unknown"
ROLE_TYPES = [
    "GenAI / LLM Engineer",
    "Research Scientist",
    "Machine Learning Engineer",
    "Analytics-focused Data Scientist",
    "Applied Data Scientist",
]
SENIORITY_LEVELS = ["Junior", "Mid", "Senior", "Staff/Lead"]  # list position = rank
EMPLOYMENT_TYPES = ["Full-time", "Part-time", "Contract", "Internship", "Temporary", "Volunteer"]
WORK_MODES = ["Remote", "Hybrid", "Onsite"]
QUALITY_LEVELS = ["high", "medium", "low"]

# (substring of the cleaned title, canonical title); first hit wins
TITLE_RULES = [
    ("machine learning engineer", "Machine Learning Engineer"),
    ("ml engineer", "Machine Learning Engineer"),
    ("mle", "Machine Learning Engineer"),
    ("applied scientist", "Applied Scientist"),
    ("research scientist", "Research Scientist"),
    ("research engineer", "Research Engineer"),
    ("genai engineer", "GenAI / LLM Engineer"),
    ("llm engineer", "GenAI / LLM Engineer"),
    ("gen ai engineer", "GenAI / LLM Engineer"),
    ("ai engineer", "AI Engineer"),
    ("data analyst", "Data Analyst"),
    ("data engineer", "Data Engineer"),
    ("analytics engineer", "Analytics Engineer"),
    ("data scientist", "Data Scientist"),
    ("statistician", "Statistician"),
    ("quantitative analyst", "Quantitative Analyst"),
    ("quant researcher", "Quantitative Researcher"),
]

# keywords looked for in a title; up to 3 characters they must stand alone as a word
TITLE_KEYWORDS = [
    "ML", "AI", "NLP", "LLM", "GenAI", "Gen AI", "Generative AI", "Computer Vision", "CV",
    "Deep Learning", "Reinforcement Learning", "Fraud", "Risk", "Ads", "Search", "Ranking",
    "Recommendation", "Supply Chain", "Healthcare", "Fintech", "E-commerce", "Production",
    "Platform", "Infrastructure", "Applied", "Analytics", "Growth", "Marketing", "Product",
    "L3", "L4", "L5", "L6", "L7", "Senior", "Staff", "Lead", "Principal", "Junior", "Intern",
]
TITLE_KEYWORD_BOUNDED_UP_TO = 3

# (spelling in lower case, canonical skill); up to 2 characters no letter may touch it
SKILLS = [
    ("python", "Python"), ("python3", "Python"), ("py", "Python"), ("r", "R"), ("r language", "R"),
    ("sql", "SQL"), ("scala", "Scala"), ("java", "Java"), ("javascript", "JavaScript"),
    ("js", "JavaScript"), ("typescript", "TypeScript"), ("ts", "TypeScript"), ("c++", "C++"),
    ("cpp", "C++"), ("c#", "C#"), ("golang", "Go"), ("go", "Go"), ("julia", "Julia"),
    ("rust", "Rust"), ("bash", "Bash"), ("shell", "Shell"), ("sas", "SAS"), ("matlab", "MATLAB"),
    ("stata", "Stata"),
    ("tensorflow", "TensorFlow"), ("tf", "TensorFlow"), ("pytorch", "PyTorch"),
    ("torch", "PyTorch"), ("keras", "Keras"), ("scikit-learn", "scikit-learn"),
    ("sklearn", "scikit-learn"), ("xgboost", "XGBoost"), ("lightgbm", "LightGBM"),
    ("catboost", "CatBoost"), ("jax", "JAX"), ("hugging face", "Hugging Face"),
    ("huggingface", "Hugging Face"), ("transformers", "Hugging Face Transformers"),
    ("langchain", "LangChain"), ("llamaindex", "LlamaIndex"), ("llama index", "LlamaIndex"),
    ("openai", "OpenAI API"), ("gpt", "GPT"), ("chatgpt", "ChatGPT"),
    ("spark", "Apache Spark"), ("pyspark", "PySpark"), ("apache spark", "Apache Spark"),
    ("hadoop", "Hadoop"), ("hive", "Hive"), ("kafka", "Kafka"), ("airflow", "Apache Airflow"),
    ("apache airflow", "Apache Airflow"), ("dbt", "dbt"), ("snowflake", "Snowflake"),
    ("bigquery", "BigQuery"), ("redshift", "Redshift"), ("databricks", "Databricks"),
    ("aws", "AWS"), ("amazon web services", "AWS"), ("gcp", "GCP"), ("google cloud", "GCP"),
    ("azure", "Azure"), ("microsoft azure", "Azure"), ("sagemaker", "AWS SageMaker"),
    ("vertex ai", "Vertex AI"),
    ("docker", "Docker"), ("kubernetes", "Kubernetes"), ("k8s", "Kubernetes"),
    ("mlflow", "MLflow"), ("kubeflow", "Kubeflow"), ("wandb", "Weights & Biases"),
    ("weights and biases", "Weights & Biases"), ("neptune", "Neptune.ai"), ("ci/cd", "CI/CD"),
    ("cicd", "CI/CD"), ("git", "Git"), ("github", "GitHub"), ("gitlab", "GitLab"),
    ("terraform", "Terraform"),
    ("tableau", "Tableau"), ("power bi", "Power BI"), ("powerbi", "Power BI"),
    ("looker", "Looker"), ("matplotlib", "Matplotlib"), ("seaborn", "Seaborn"),
    ("plotly", "Plotly"), ("d3", "D3.js"),
    ("postgresql", "PostgreSQL"), ("postgres", "PostgreSQL"), ("mysql", "MySQL"),
    ("mongodb", "MongoDB"), ("mongo", "MongoDB"), ("redis", "Redis"),
    ("elasticsearch", "Elasticsearch"), ("neo4j", "Neo4j"), ("cassandra", "Cassandra"),
    ("dynamodb", "DynamoDB"),
    ("pandas", "Pandas"), ("numpy", "NumPy"), ("scipy", "SciPy"), ("nltk", "NLTK"),
    ("spacy", "spaCy"), ("opencv", "OpenCV"), ("statsmodels", "Statsmodels"),
    ("machine learning", "Machine Learning"), ("ml", "Machine Learning"),
    ("deep learning", "Deep Learning"), ("dl", "Deep Learning"),
    ("natural language processing", "NLP"), ("nlp", "NLP"), ("computer vision", "Computer Vision"),
    ("reinforcement learning", "Reinforcement Learning"), ("rl", "Reinforcement Learning"),
    ("generative ai", "Generative AI"), ("genai", "Generative AI"), ("gen ai", "Generative AI"),
    ("llm", "Large Language Models"), ("large language model", "Large Language Models"),
    ("large language models", "Large Language Models"), ("rag", "RAG"),
    ("retrieval augmented generation", "RAG"), ("time series", "Time Series"),
    ("forecasting", "Forecasting"), ("a/b testing", "A/B Testing"), ("ab testing", "A/B Testing"),
    ("bayesian", "Bayesian Methods"), ("causal inference", "Causal Inference"),
    ("recommendation systems", "Recommendation Systems"),
    ("recommender systems", "Recommendation Systems"),
    ("feature engineering", "Feature Engineering"), ("data pipelines", "Data Pipelines"),
    ("etl", "ETL"), ("elt", "ELT"),
]
SKILL_BOUNDED_UP_TO = 2

# skills that count as tools or frameworks
TOOLS = [
    "Python", "R", "SQL", "Scala", "Java", "JavaScript", "TypeScript", "C++", "C#", "Go", "Julia",
    "Rust", "Bash", "Shell", "SAS", "MATLAB", "TensorFlow", "PyTorch", "Keras", "scikit-learn",
    "XGBoost", "LightGBM", "CatBoost", "JAX", "Hugging Face", "Hugging Face Transformers",
    "LangChain", "LlamaIndex", "OpenAI API", "Apache Spark", "PySpark", "Hadoop", "Hive", "Kafka",
    "Apache Airflow", "dbt", "Snowflake", "BigQuery", "Redshift", "Databricks", "AWS", "GCP",
    "Azure", "AWS SageMaker", "Vertex AI", "Docker", "Kubernetes", "MLflow", "Kubeflow",
    "Weights & Biases", "Neptune.ai", "CI/CD", "Git", "GitHub", "GitLab", "Terraform", "Tableau",
    "Power BI", "Looker", "Matplotlib", "Seaborn", "Plotly", "D3.js", "PostgreSQL", "MySQL",
    "MongoDB", "Redis", "Elasticsearch", "Neo4j", "Cassandra", "DynamoDB", "Pandas", "NumPy",
    "SciPy", "NLTK", "spaCy", "OpenCV", "Statsmodels",
]

# words that open a required / optional section, looked for in a paragraph's first characters
REQUIRED_HEADING = (
    "requirement|required|must have|what you.ll need|qualifications|what we.re looking for|"
    "minimum|basic qualifications|what you bring|essential"
)
OPTIONAL_HEADING = (
    "nice.to.have|preferred|bonus|plus|ideal|desirable|additional|not required but|"
    "good to have|extra credit"
)
HEADING_WINDOW = 150

# role -> keywords; table order breaks ties
ROLE_SIGNALS = [
    ("GenAI / LLM Engineer", [
        "llm", "large language model", "generative ai", "genai", "gen ai", "prompt engineering",
        "rag", "retrieval augmented", "langchain", "fine-tuning", "fine tuning", "rlhf",
        "instruction tuning", "chatbot", "conversational ai", "foundation model"]),
    ("Research Scientist", [
        "publish", "publications", "research paper", "arxiv", "neurips", "icml", "iclr", "cvpr",
        "acl", "aaai", "novel algorithm", "state-of-the-art", "state of the art", "theoretical",
        "advance the field", "phd required", "ph.d. required"]),
    ("Machine Learning Engineer", [
        "deploy model", "model deployment", "production model", "model serving", "mlops",
        "ml infrastructure", "ml platform", "feature store", "model monitoring", "model pipeline",
        "real-time inference", "batch inference", "microservice", "scaling", "latency",
        "throughput"]),
    ("Analytics-focused Data Scientist", [
        "stakeholder", "business insight", "dashboard", "kpi", "reporting", "product analytics",
        "growth analytics", "experimentation", "a/b test", "ab test", "metric", "sql-heavy",
        "data-driven decision", "business intelligence"]),
    ("Applied Data Scientist", [
        "build model", "building model", "predictive model", "classification", "regression",
        "clustering", "feature engineering", "model training", "end-to-end", "solve business",
        "applied machine learning"]),
]
ROLE_TOOLS = {
    "GenAI / LLM Engineer": ["LangChain", "LlamaIndex", "OpenAI API", "Hugging Face Transformers"],
    "Machine Learning Engineer": ["Docker", "Kubernetes", "MLflow", "Kubeflow", "Apache Airflow"],
}
OPTIONAL_MARKERS = ["nice to have", "nice-to-have", "preferred", "bonus", "plus"]
ROLE_WEIGHTS = {"title": 3.0, "core": 2.0, "optional": 0.5, "tool": 1.0}

# (word in the title, level)
SENIORITY_TITLE = [
    ("intern", "Junior"), ("junior", "Junior"), ("entry level", "Junior"),
    ("entry-level", "Junior"), ("associate", "Junior"), ("l3", "Mid"), ("mid-level", "Mid"),
    ("mid level", "Mid"), ("l4", "Mid"), ("senior", "Senior"), ("sr.", "Senior"),
    ("sr ", "Senior"), ("l5", "Senior"), ("staff", "Staff/Lead"), ("lead", "Staff/Lead"),
    ("principal", "Staff/Lead"), ("director", "Staff/Lead"), ("head of", "Staff/Lead"),
    ("l6", "Staff/Lead"), ("l7", "Staff/Lead"),
]
# (phrase in the description, level)
SENIORITY_VERBS = [
    ("mentor", "Senior"), ("lead a team", "Staff/Lead"), ("manage a team", "Staff/Lead"),
    ("own the roadmap", "Staff/Lead"), ("define strategy", "Staff/Lead"),
    ("set technical direction", "Staff/Lead"), ("architect", "Senior"),
    ("design system", "Senior"), ("cross-functional", "Senior"), ("influence", "Senior"),
    ("drive", "Senior"),
]
# (from year, below year, level)
SENIORITY_YEARS = [(0, 2, "Junior"), (2, 5, "Mid"), (5, 8, "Senior"), (8, 100, "Staff/Lead")]

# (substring, value); first hit wins
EMPLOYMENT_RULES = [
    ("full-time", "Full-time"), ("full time", "Full-time"), ("part-time", "Part-time"),
    ("part time", "Part-time"), ("contract", "Contract"), ("contractor", "Contract"),
    ("freelance", "Contract"), ("internship", "Internship"), ("intern", "Internship"),
    ("temporary", "Temporary"), ("temp", "Temporary"), ("volunteer", "Volunteer"),
]
WORK_MODE_RULES = [
    ("remote", "Remote"), ("fully remote", "Remote"), ("work from home", "Remote"),
    ("wfh", "Remote"), ("hybrid", "Hybrid"), ("on-site", "Onsite"), ("onsite", "Onsite"),
    ("on site", "Onsite"), ("in-office", "Onsite"), ("in office", "Onsite"),
]

# years of experience: patterns tried in this order, group 1 is the number
EXPERIENCE_PATTERNS = [
    r"(\d+)\s*\+?\s*(?:to|-)\s*\d*\s*(?:years?|yrs?)\s*(?:of\s+)?(?:experience|exp\.?)?",
    r"(\d+)\s*\+?\s*(?:years?|yrs?)\s+(?:of\s+)?(?:experience|exp\.?)",
    r"(?:minimum|at\s+least|min\.?)\s*(\d+)\s*(?:years?|yrs?)",
    r"experience\s*:\s*(\d+)\s*\+?\s*(?:years?|yrs?)",
]
YEARS_MENTION = r"\d+\s*\+?\s*(?:years?|yrs?)"

# relative dates: days per unit; other dates: formats tried in this order
AGO_PATTERN = r"(\d+)\s*(second|minute|hour|day|week|month|year)s?\s*ago"
AGO_UNIT_DAYS = [
    ("second", 0), ("minute", 0), ("hour", 0), ("day", 1), ("week", 7), ("month", 30), ("year", 365),
]
DATE_FORMATS = ["yyyy-M-d", "MMMM d, yyyy", "MMM d, yyyy", "M/d/yyyy"]

US_STATES = [
    ("AL", "Alabama"), ("AK", "Alaska"), ("AZ", "Arizona"), ("AR", "Arkansas"),
    ("CA", "California"), ("CO", "Colorado"), ("CT", "Connecticut"), ("DE", "Delaware"),
    ("FL", "Florida"), ("GA", "Georgia"), ("HI", "Hawaii"), ("ID", "Idaho"), ("IL", "Illinois"),
    ("IN", "Indiana"), ("IA", "Iowa"), ("KS", "Kansas"), ("KY", "Kentucky"), ("LA", "Louisiana"),
    ("ME", "Maine"), ("MD", "Maryland"), ("MA", "Massachusetts"), ("MI", "Michigan"),
    ("MN", "Minnesota"), ("MS", "Mississippi"), ("MO", "Missouri"), ("MT", "Montana"),
    ("NE", "Nebraska"), ("NV", "Nevada"), ("NH", "New Hampshire"), ("NJ", "New Jersey"),
    ("NM", "New Mexico"), ("NY", "New York"), ("NC", "North Carolina"), ("ND", "North Dakota"),
    ("OH", "Ohio"), ("OK", "Oklahoma"), ("OR", "Oregon"), ("PA", "Pennsylvania"),
    ("RI", "Rhode Island"), ("SC", "South Carolina"), ("SD", "South Dakota"), ("TN", "Tennessee"),
    ("TX", "Texas"), ("UT", "Utah"), ("VT", "Vermont"), ("VA", "Virginia"), ("WA", "Washington"),
    ("WV", "West Virginia"), ("WI", "Wisconsin"), ("WY", "Wyoming"),
    ("DC", "District of Columbia"),
]
COUNTRIES = [
    "united states", "united states of america", "usa", "us", "canada", "united kingdom", "uk",
    "ireland", "india", "australia", "germany", "france", "spain", "italy", "netherlands",
    "sweden", "norway", "denmark", "finland", "brazil", "mexico", "singapore", "japan", "china",
    "south korea", "israel", "uae", "united arab emirates", "switzerland", "belgium", "austria",
    "poland", "portugal", "czech republic", "new zealand", "south africa", "argentina",
    "colombia", "chile", "philippines", "indonesia", "thailand", "vietnam", "malaysia", "taiwan",
    "hong kong", "nigeria", "kenya", "egypt", "saudi arabia",
]

# selectors of one field: (tag, attribute, value), tried in this order
DESCRIPTION_SELECTORS = [
    ("div", "class", "show-more-less-html__markup"),
    ("div", "class", "description__text"),
    ("section", "class", "show-more-less-html"),
    ("article", "class", "jobs-description"),
    ("div", "class", "jobs-description__content"),
    ("div", "class", "core-section-container__content"),
]
DESCRIPTION_MIN_CHARS = 50
FALLBACK_TAG = "div"
FALLBACK_MIN_CHARS = 200
INSIGHT_SELECTORS = [
    ("div", "class", "job-details-jobs-unified-top-card__job-insight"),
    ("div", "class", "jobs-unified-top-card__job-insight"),
    ("ul", "class", "job-details-jobs-unified-top-card__job-insight"),
    ("div", "class", "top-card-layout__entity-info"),
    ("section", "class", "top-card-layout"),
]
SALARY_SELECTORS = [
    ("div", "class", "salary-main-rail__data-body"),
    ("span", "class", "top-card-layout__salary-info"),
    ("div", "class", "compensation__salary"),
    ("div", "class", "job-details-jobs-unified-top-card__job-insight--highlight"),
]
APPLICANT_SELECTORS = [
    ("span", "class", "num-applicants__caption"),
    ("span", "class", "topcard__flavor--metadata"),
    ("figcaption", "class", "num-applicants__caption"),
]
EASY_APPLY_SELECTORS = [
    ("span", "class", "easy-apply-badge"),
    ("button", "class", "jobs-apply-button--top-card"),
    ("span", "class", "topcard__flavor--easy-apply"),
]
POSTED_BY_SELECTORS = [
    ("div", "class", "message-the-recruiter"),
    ("div", "class", "hirer-card__hirer-information"),
    ("a", "class", "message-the-recruiter__cta"),
]
LOCATION_SELECTORS = [
    ("span", "class", "job-details-jobs-unified-top-card__primary-description-container"),
    ("span", "class", "topcard__flavor--bullet"),
    ("span", "class", "job-search-card__location"),
]
REMOTE_LABEL_SELECTORS = [
    ("span", "class", "job-details-jobs-unified-top-card__workplace-type"),
    ("span", "class", "topcard__flavor--workplace-type"),
    ("span", "class", "job-search-card__workplace-type"),
]
CRITERIA_ITEM = ("li", "class", "description__job-criteria-item")
CRITERIA_HEADER = ("h3", "class", "description__job-criteria-subheader")
CRITERIA_VALUE = ("span", "class", "description__job-criteria-text")
CRITERIA_COLUMNS = [
    ("employment_type_raw", "employment_type"),
    ("seniority_raw", "seniority_level"),
    ("industry_raw", "industries"),
    ("job_function_raw", "job_function"),
]
JSON_LD_TYPE = "application/ld+json"
JOB_JSON_WORDS = [
    "jobPosting", "hiringOrganization", "employmentType", "jobLocation", "baseSalary",
    "validThrough",
]
ABOUT_SELECTORS = [
    ("p", "class", "break-words white-space-pre-wrap mb5 text-body-small t-black--light"),
    ("section", "class", "core-section-container"),
    ("p", "class", "break-words"),
    ("div", "class", "core-section-container__content"),
    ("section", "data-test-id", "about-us"),
]
ABOUT_MIN_CHARS = 10
# (word in the label, field); first hit wins
COMPANY_FACTS = [
    ("industry", "industry"), ("company size", "size"), ("headquarters", "headquarters"),
    ("type", "type"), ("specialties", "specialties"), ("founded", "founded"),
    ("website", "website"),
]
INDUSTRY_FALLBACK = ("div", "data-test-id", "about-us__industry")
CARD_TAG = "li"
# (column, selector, attribute to read or None for the text)
CARD_FIELDS = [
    ("raw_title", ("h3", "class", "base-search-card__title"), None),
    ("company", ("h4", "class", "base-search-card__subtitle"), None),
    ("raw_location", ("span", "class", "job-search-card__location"), None),
    ("date_posted_raw", ("time", "class", "job-search-card__listdate"), None),
    ("date_posted_attr", ("time", "class", "job-search-card__listdate"), "datetime"),
    ("job_url", ("a", "class", "base-card__full-link"), "href"),
    ("company_url", ("a", "class", "hidden-nested-link"), "href"),
]
FETCH_FAILED = "Failed to fetch page"
DESCRIPTION_FAILED = "Could not extract job description (selectors failed)"

# frequent function words per language, for language detection and token cleaning
STOP_WORDS = {
    "en": (
        "a an and are as at be been but by can for from had has have he her his if in into is it its"
        " more no not of on or our she so than that the their them then there they this to was we"
        " were what when which who will with would you your"
    ).split(),
    "fr": (
        "au aux avec ce ces cette dans de des du elle en est et il ils je la le les leur mais ne nous"
        " on ou par pas plus pour que qui sa se ses son sont sur un une vous"
    ).split(),
    "de": (
        "aber als am an auch auf aus bei das dass dem den der des die durch ein eine einen einer es"
        " für hat ich im in ist mit nach nicht noch oder sich sie sind so um und von vor war wie wird"
        " zu zum zur"
    ).split(),
    "es": (
        "al como con de del el en era es esta este fue ha la las lo los más me mi muy no o para pero"
        " por que se sin sobre son su sus también un una uno y ya"
    ).split(),
}
