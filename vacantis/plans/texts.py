"""Queries on texts: what a vacancy states, categories, scores, contacts and dates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import contacts, dates, text
from ..functions import statements as st
from ..operators.reasons import score
from ..session import load
from .registry import query

SQUASH = "trim(regexp_replace(coalesce({c}, ''), '[\\s\\x{{00a0}}]+', ' ', 'g'))"
WORDS = "trim(regexp_replace(lower(" + SQUASH + "), '[^a-z0-9]+', ' ', 'g'))"
SPAN = "(?:\\d+\\s*(?:-|–|to)\\s*\\d+|\\d+\\+?|minimum\\s+\\d+)"
TITLE = (
    "trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower("
    + SQUASH
    + f"), '\\([^)]*{SPAN}\\s*(?:years?|yrs?)[^)]*\\)', ' ', 'g'), '\\b{SPAN}\\s*(?:years?|yrs?)\\s*(?:of\\s+experience)?\\b', ' ', 'g'), '\\bof\\s+experience\\b', ' ', 'g'), '[^a-z0-9+]+', ' ', 'g'))"
)


def sql_text(template: str, column: str) -> str:
    out = template.replace("{c}", column)
    return out.replace("{{", "{").replace("}}", "}")


KEY = f"{sql_text(WORDS, 'employer_name')} || '|' || {sql_text(TITLE, 'title')} || '|' || {sql_text(WORDS, 'location')}"
SKILLS = ("AutoCAD", "Revit", "SketchUp", "Lumion", "V-Ray", "Rhino", "Photoshop", "3ds Max", "Tekla", "QGIS")


def _any(column: str, terms: tuple[str, ...]) -> str:
    return "(" + " OR ".join(f"contains(lower(coalesce({column}, '')), '{t.lower()}')" for t in terms) + ")"


def _case(column: str, rules: dict[str, tuple[str, ...]], default: str) -> str:
    return "CASE " + " ".join(f"WHEN {_any(column, terms)} THEN '{name}'" for name, terms in rules.items()) + f" ELSE '{default}' END"


@query(f"SELECT row_id, {KEY} AS natural_key, substr(sha256({KEY}), 1, 24) AS fingerprint, substr(sha1(substr(sha256({KEY}), 1, 24)), 1, 16) AS job_id FROM website")
def natural_keys(spark: SparkSession, root: str) -> DataFrame:
    key = text.natural_key(F.col("employer_name"), F.col("title"), F.col("location"))
    web = load(spark, root, "website").select("row_id", key.alias("natural_key"))
    return web.select("row_id", "natural_key", text.fingerprint(F.col("natural_key")).alias("fingerprint"), text.job_id(text.fingerprint(F.col("natural_key"))).alias("job_id"))


@query("SELECT candidate_id, 'CAND-' || upper(substr(sha1(concat_ws('|', lower(trim(role)), lower(trim(company)), lower(trim(signal_url)))), 1, 14)) AS made_id FROM candidates")
def candidate_ids(spark: SparkSession, root: str) -> DataFrame:
    return load(spark, root, "candidates").select("candidate_id", text.stable_id("CAND", F.col("role"), F.col("company"), F.col("signal_url")).alias("made_id"))


@query(f"SELECT row_id, {_case('title', text.ROLE_CATEGORIES, 'Architecture / Design')} AS by_title, {_case('''concat_ws(' ', coalesce(title, ''), coalesce(description, ''))''', text.TEXT_CATEGORIES, 'Architecture')} AS by_text FROM website")
def categories(spark: SparkSession, root: str) -> DataFrame:
    return load(spark, root, "website").select("row_id", text.role_category(F.col("title")).alias("by_title"), text.text_category(F.col("title"), F.col("description")).alias("by_text"))


@query("SELECT row_id, array_to_string(list_filter([" + ", ".join(f"'{s}'" for s in SKILLS) + "], lambda t: contains(lower(coalesce(description, '')), lower(t))), ', ') AS skills FROM website")
def skills(spark: SparkSession, root: str) -> DataFrame:
    return load(spark, root, "website").select("row_id", text.terms_found(F.col("description"), SKILLS).alias("skills"))


@query("SELECT row_id, array_to_string(list_filter(l, lambda t, i: list_position(list_transform(l, lambda x: lower(x)), lower(t)) = i), '|') AS tags FROM (SELECT row_id, list_filter(list_transform(string_split_regex(" + sql_text(SQUASH, "tag") + ", '[,;|]+'), lambda x: trim(x)), lambda x: x <> '') AS l FROM website)")
def tags(spark: SparkSession, root: str) -> DataFrame:
    return load(spark, root, "website").select("row_id", text.pipe_tags(F.col("tag")).alias("tags"))


YEARS = r"(?i)\b(\d{1,2})\s*\+?\s*(?:years?|yrs?)\b"


@query(f"SELECT row_id, list_max(y) AS most_years, list_min(y) AS least_years, len(y) AS stated FROM (SELECT row_id, list_transform(regexp_extract_all(coalesce(description, ''), '{YEARS}', 1), lambda x: CAST(x AS INT)) AS y FROM website) WHERE len(y) > 0")
def years_stated(spark: SparkSession, root: str) -> DataFrame:
    y = load(spark, root, "website").select("row_id", st.years(F.col("description")).alias("y")).where(F.size("y") > 0)
    return y.select("row_id", F.array_max("y").alias("most_years"), F.array_min("y").alias("least_years"), F.size("y").cast("long").alias("stated"))


@query(r"SELECT row_id, coalesce(nullif(regexp_extract(coalesce(experience, ''), '(?i)\b\d+\s*(?:-|–|to)\s*\d+\s*(?:years?|yrs?)\b', 0), ''), nullif(regexp_extract(coalesce(experience, ''), '(?i)\b\d+\+\s*(?:years?|yrs?)\b', 0), ''), nullif(regexp_extract(coalesce(experience, ''), '(?i)\bminimum\s+\d+\s*(?:years?|yrs?)\b', 0), ''), nullif(regexp_extract(coalesce(experience, ''), '(?i)\b(?:experience|exp)\s*[:\-]?\s*\d+\s*(?:-|–|to)?\s*\d*\s*(?:years?|yrs?)\b', 0), ''), '') AS experience FROM website")
def experience(spark: SparkSession, root: str) -> DataFrame:
    return load(spark, root, "website").select("row_id", st.experience(F.col("experience")).alias("experience"))


MENTION = r"(?i)(?:minimum\s+)?\d+\s*(?:(?:-|–|to)\s*\d+|\+)?\s*(?:years?|yrs?)"


@query(
    f"WITH t AS (SELECT row_id, {sql_text(SQUASH, 'description')} AS d FROM website), m AS (SELECT row_id, regexp_extract_all(d, '{MENTION}', 0) AS m, string_split_regex(d, '{MENTION}') AS b FROM t), "
    r"c AS (SELECT row_id, list_filter(list_transform(range(1, len(m) + 1), lambda i: struct_pack(m := m[i], near := lower(right(b[i], 35) || m[i] || left(b[i + 1], 45)), most := list_max(list_transform(regexp_extract_all(m[i], '(?i)\b(\d{1,2})\s*\+?\s*(?:years?|yrs?)\b', 1), lambda y: CAST(y AS INT))))), lambda x: (NOT contains(x.near, 'since') OR contains(x.near, 'experience')) AND coalesce(x.most <= 35, false)) AS k FROM m) "
    r"SELECT row_id, coalesce(regexp_extract(list_filter(k, lambda x: regexp_matches(x.m, '\d\s*(?:-|–|to)\s*\d'))[1].m, '\d.*$', 0), list_filter(k, lambda x: regexp_matches(x.m, '(?i)^minimum\s+\d'))[1].m, k[1].m, '') AS experience FROM c"
)
def experience_in_text(spark: SparkSession, root: str) -> DataFrame:
    return load(spark, root, "website").select("row_id", st.plausible_experience(F.col("description")).alias("experience"))


@query(
    "SELECT row_id, CASE WHEN n[1] IS NULL OR n[1] = 0 THEN '' ELSE CAST(CAST(n[1] AS BIGINT) AS VARCHAR) END AS low, CASE WHEN n[2] IS NULL OR n[2] = 0 THEN '' ELSE CAST(CAST(n[2] AS BIGINT) AS VARCHAR) END AS high, per FROM (SELECT row_id, list_transform(regexp_extract_all(t, '(\\d+(?:,\\d{2,3})*(?:\\.\\d+)?)', 1), lambda x: CAST(replace(x, ',', '') AS DOUBLE)) AS n, CASE WHEN regexp_matches(lower(t), 'per month|/month|monthly|p\\.m\\.') THEN 'Monthly' WHEN regexp_matches(lower(t), 'per annum|/year|yearly|annual|lpa') THEN 'Yearly' WHEN regexp_matches(lower(t), 'per hour|/hour|hourly') THEN 'Hourly' ELSE '' END AS per FROM (SELECT row_id, trim(concat_ws(' - ', nullif(salary, ''), nullif(max_salary, ''))) || ' ' || coalesce(salary_type, '') AS t FROM website))"
)
def salaries(spark: SparkSession, root: str) -> DataFrame:
    stated = F.concat(F.trim(F.concat_ws(" - ", F.nullif("salary", F.lit("")), F.nullif("max_salary", F.lit("")))), F.lit(" "), F.coalesce("salary_type", F.lit("")))
    parts = st.salary_parts(stated)
    return load(spark, root, "website").select("row_id", parts.alias("p")).select("row_id", "p.low", "p.high", "p.per")


@query(r"SELECT row_id, regexp_extract(regexp_replace(coalesce(description, '') || ' ' || coalesce(phone, ''), '[\s().\-]+', '', 'g'), '(?:\+91)?[6-9]\d{9}', 0) AS phone FROM website")
def phones(spark: SparkSession, root: str) -> DataFrame:
    return load(spark, root, "website").select("row_id", contacts.phone(F.concat(F.coalesce("description", F.lit("")), F.lit(" "), F.coalesce("phone", F.lit("")))).alias("phone"))


RANK = "CASE WHEN regexp_matches(l, 'career|jobs|recruit|talent|hiring') THEN 0 WHEN l IN ('hr', 'humanresources', 'human.resources') OR l LIKE 'hr.%' OR l LIKE 'hr-%' THEN 1 WHEN regexp_matches(l, 'people|team') THEN 2 WHEN regexp_matches(l, 'hello|contact|info|office') THEN 5 WHEN regexp_matches(l, 'press|media|exec|admin') THEN 9 ELSE 6 END"


@query(
    "WITH e AS (SELECT row_id, lower(unnest(regexp_extract_all(concat_ws(' ', employer_email, apply_email, description), '[A-Za-z0-9._%+\\-]+@[A-Za-z0-9.\\-]+\\.[A-Za-z]{2,}', 0))) AS e FROM website), "
    f"r AS (SELECT row_id, e, {RANK} AS k FROM (SELECT row_id, e, split_part(e, '@', 1) AS l FROM e WHERE NOT regexp_matches(e, '\\.(?:png|jpg|jpeg|webp|svg)$')) ), "
    "b AS (SELECT row_id, e, row_number() OVER (PARTITION BY row_id ORDER BY k, length(e), e) AS n FROM r) "
    "SELECT w.row_id, coalesce(b.e, '') AS email FROM website w LEFT JOIN b ON b.row_id = w.row_id AND b.n = 1"
)
def best_emails(spark: SparkSession, root: str) -> DataFrame:
    return load(spark, root, "website").select("row_id", contacts.best_email(F.concat_ws(" ", "employer_email", "apply_email", "description")).alias("email"))


@query("SELECT row_id, CAST(try_strptime(expiry_date, '%d-%m-%Y') AS DATE) AS expiry, coalesce(strftime(try_strptime(expiry_date, '%d-%m-%Y'), '%d-%m-%Y'), '') AS shown, coalesce(CAST(try_strptime(nullif(application_deadline_date, ''), '%d-%m-%Y') AS DATE), DATE '2026-06-08') AS until FROM website")
def expiry_dates(spark: SparkSession, root: str) -> DataFrame:
    d = dates.parse_date(F.col("expiry_date"))
    until = dates.rolling_expiry(dates.parse_date(F.col("application_deadline_date")), F.lit("2026-06-01").cast("date"), 7)
    return load(spark, root, "website").select("row_id", d.alias("expiry"), dates.day_text(d).alias("shown"), until.alias("until"))


@query(r"SELECT row_id, CASE WHEN regexp_matches(b, 'intern|trainee|junior|0-2 year|0–2 year|1-3 year|1–3 year') THEN 'Entry Level' WHEN regexp_matches(b, 'senior|lead|principal|associate|director|head') THEN 'Senior Level' WHEN m >= 7 THEN 'Senior Level' WHEN m >= 3 THEN 'Mid Level' WHEN m IS NOT NULL THEN 'Entry Level' ELSE '' END AS level FROM (SELECT row_id, lower(concat_ws(' ', trim(coalesce(title, '')), trim(coalesce(experience, '')))) AS b, list_min(list_transform(regexp_extract_all(coalesce(experience, ''), '\b(\d+)\b', 1), lambda x: CAST(x AS INT))) AS m FROM website)")
def career_levels(spark: SparkSession, root: str) -> DataFrame:
    return load(spark, root, "website").select("row_id", st.career_level(F.col("title"), F.col("experience")).alias("level"))


NOISE = ("our services", "services", "projects", "portfolio", "clients", "get a quote", "gallery", "contact us")
EVIDENCE = (("apply", 2), ("interview", 2), ("experience", 1), ("portfolio", 1), ("shortlisted", 2), ("salary", 1))


@query(f"SELECT row_id, {' + '.join(f'''CAST(contains(lower(coalesce(description, '')), '{t}') AS INT)''' for t in NOISE)} AS noise, least(6, {' + '.join(f'''{n} * CAST(contains(lower(coalesce(description, '')), '{t}') AS INT)''' for t, n in EVIDENCE)}) AS evidence FROM website")
def text_scores(spark: SparkSession, root: str) -> DataFrame:
    d = F.col("description")
    return load(spark, root, "website").select("row_id", text.count_terms(d, NOISE).alias("noise"), score([(n, text.contains_any(d, (t,))) for t, n in EVIDENCE], most=6).alias("evidence"))


def _typed() -> str:
    noun = r"\s+(?:" + "|".join(st.TYPE_NOUNS) + r")\b"
    named = [f"CASE WHEN regexp_matches(t, '{st.any_of(ws)}{noun}') THEN '{n}' END" for n, ws in st.STATED_TYPES.items()]
    under = r"array_to_string(regexp_extract_all(t, '(?:job|employment|position)\s*type\s*[:\-]?\s*([^.;|]{1,80})', 1), ' ')"
    listed = [f"CASE WHEN regexp_matches({under}, '{st.any_of(ws)}\\b') THEN '{n}' END" for n, ws in st.LABELLED_TYPES.items()]
    each = ", ".join(named + listed)
    return f"array_to_string(list_filter([{each}], lambda x, i: x IS NOT NULL AND list_position([{each}], x) = i), ', ')"


def _degree() -> str:
    named = ", ".join("nullif(regexp_extract(d, '{}', 0), '')".format(st.loosely(n).replace("'", "''")) for n in st.DEGREES)
    behind = rf"regexp_extract(d, '(?i)(?:{'|'.join(st.DEGREE_LABELS)})\s*[:\-]\s*(.*)$', 1)"
    value = rf"regexp_replace(string_split_regex({behind}, '(?i)\s(?:{'|'.join(st.LABELS)})(?:\s*[:\-]|\s|$)')[1], '^[ \-|;,]+|[ \-|;,]+$', '', 'g')"
    return rf"coalesce(trim(regexp_replace(coalesce({named}), '(?i)\b(b|m)\.\s*(arch\b)', '\1.\2', 'g')), CASE WHEN length({value}) BETWEEN 3 AND 160 THEN {value} ELSE '' END)"


STATED = "concat_ws(' ', description, 'Gender: ' || gender, 'Qualification: ' || qualification, 'Job type: ' || type, salary, CASE WHEN urgent = 'yes' THEN 'Urgent hiring' END)"


def _stated() -> Column:
    """The description together with the columns that state the same facts under their labels, so that every rule has rows."""
    return F.concat_ws(" ", "description", F.concat(F.lit("Gender: "), "gender"), F.concat(F.lit("Qualification: "), "qualification"), F.concat(F.lit("Job type: "), "type"), "salary", F.when(F.col("urgent") == "yes", "Urgent hiring"))


@query(f"SELECT row_id, {_typed()} AS type, {_degree()} AS qualification FROM (SELECT row_id, {sql_text(SQUASH, STATED)} AS d, lower({sql_text(SQUASH, STATED)}) AS t FROM website)")
def types_and_degrees(spark: SparkSession, root: str) -> DataFrame:
    return load(spark, root, "website").select("row_id", _stated().alias("d")).select("row_id", st.employment_type(F.col("d")).alias("type"), st.qualification(F.col("d")).alias("qualification"))


PAY = ", ".join(f"nullif(regexp_extract(d, '{p}', 0), '')" for p in st.SALARIES)


@query(
    rf"SELECT row_id, CASE WHEN g IN ('both', 'any') THEN 'Both' ELSE upper(left(g, 1)) || substr(g, 2) END AS gender, CASE WHEN {_any('d', st.URGENT)} THEN 'yes' ELSE 'no' END AS urgent, trim(coalesce({PAY}, '')) AS salary "
    rf"FROM (SELECT row_id, d, lower(regexp_extract(d, '(?i)\bgender\s*[:\-]\s*(male|female|both|any)\b', 1)) AS g FROM (SELECT row_id, {sql_text(SQUASH, STATED)} AS d FROM website))"
)
def gender_haste_and_pay(spark: SparkSession, root: str) -> DataFrame:
    d = text.squashed(F.col("d"))
    return load(spark, root, "website").select("row_id", _stated().alias("d")).select("row_id", st.gender(d).alias("gender"), st.urgent(d).alias("urgent"), st.salary_text(d).alias("salary"))


@query()
def statements(spark: SparkSession, root: str) -> DataFrame:
    """All that descriptions state, as one row for each; the parts have SQL of their own, dates in words have none."""
    d = F.col("description")
    return load(spark, root, "website").select("row_id", st.employment_type(d).alias("type"), st.qualification(d).alias("qualification"), st.gender(d).alias("gender"), st.urgent(d).alias("urgent"), st.salary_text(d).alias("salary"), dates.labelled_date(d, dates.DEADLINE_LABELS).alias("deadline"))


@query()
def main_descriptions(spark: SparkSession, root: str) -> DataFrame:
    return load(spark, root, "website").select("row_id", st.main_description(F.col("description"), F.col("title"), F.col("employer_name")).alias("description"))
