"""Addresses as Column expressions. Regular expressions take them apart, as parse_url rejects hosts and paths that occur in practice."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: hosts of applicant-tracking systems, in the order in which they are tried
ATS_HOSTS = {
    "Lever": ("jobs.lever.co", "jobs.eu.lever.co"),
    "Greenhouse": ("boards.greenhouse.io", "job-boards.greenhouse.io", "boards.eu.greenhouse.io"),
    "Ashby": ("jobs.ashbyhq.com",),
    "SmartRecruiters": ("careers.smartrecruiters.com", "jobs.smartrecruiters.com"),
    "Workday": ("myworkdayjobs.com",),
    "Workable": ("apply.workable.com",),
    "Zoho Recruit": ("jobs.zohorecruit.com", "careers.zohorecruit.com"),
    "Breezy": ("breezy.hr", "jobs.breezy.hr"),
    "Teamtailor": ("teamtailor.com", "careers.teamtailor.com"),
    "Jobvite": ("jobs.jobvite.com", "jobvite.com"),
    "iCIMS": ("icims.com", "careers.icims.com"),
    "Recruitee": ("recruitee.com", "jobs.recruitee.com"),
    "BambooHR": ("bamboohr.com", "applytojob.com"),
    "Freshteam": ("freshteam.com",),
}
# fixed values: where each system keeps a board; {id} is its identifier, {host} the host of the address
ATS_BOARDS = {
    "Lever": "https://jobs.lever.co/{id}",
    "Greenhouse": "https://job-boards.greenhouse.io/{id}",
    "Ashby": "https://jobs.ashbyhq.com/{id}",
    "SmartRecruiters": "https://careers.smartrecruiters.com/{id}",
    "Workable": "https://apply.workable.com/{id}",
    "Freshteam": "https://{host}/jobs",
}
# fixed values: the board of a host that has one of its own
HOST_BOARDS = {"jobs.eu.lever.co": "https://jobs.eu.lever.co/{id}"}
# fixed values: where the identifier of a board stands, the first that is there
ATS_IDENTIFIERS = {
    "Lever": ("path",),
    "Greenhouse": ("path",),
    "Ashby": ("path",),
    "SmartRecruiters": ("path",),
    "Workable": ("path",),
    "Breezy": ("path", "label"),
    "Teamtailor": ("path", "label"),
    "Recruitee": ("path", "label"),
    "BambooHR": ("path", "label"),
    "Jobvite": ("path", "host"),
    "iCIMS": ("path", "host"),
    "Zoho Recruit": ("path", "host"),
    "Freshteam": ("tenant",),
    "Workday": ("tenant",),
}
# fixed values: first labels of a host that name no firm
COMMON_LABELS = ("www", "jobs", "careers", "apply")
# fixed values: last path parts of a careers page that names no vacancy
CAREER_PATHS = "career careers jobs job openings opening open-positions open-position opportunities opportunity join-us work-with-us vacancies vacancy".split()
# fixed values: suffixes under which content networks mirror other hosts
MIRRORS = ("global.ssl.fastly.net", "fastly.net", "cloudfront.net", "akamaized.net", "azureedge.net", "netlify.app", "workers.dev", "pages.dev", "vercel.app")
# fixed values: parameters in which search engines hide the target
REDIRECT_KEYS = ("u", "url", "uddg", "target", "r")
# fixed values: public job boards
JOB_BOARDS = ("indeed.com", "naukri.com", "foundit.in", "glassdoor.com", "glassdoor.co.in", "shine.com", "timesjobs.com", "internshala.com")
LINKEDIN = ("linkedin.com",)


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is computed once, however often it is used: as a column it would be repeated at each place."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _text(url: Column) -> Column:
    return F.coalesce(F.trim(url), F.lit(""))


def canonical_url(url: Column) -> Column:
    """Trimmed, without fragment and closing slashes; case and query stay. Null counts as empty."""
    return F.regexp_replace(F.regexp_replace(_text(url), r"#.*$", ""), r"/+$", "")


def domain(url: Column) -> Column:
    """Host in lower case without the port; empty where there is none."""
    return F.lower(F.regexp_extract(_text(url), r"^[a-zA-Z][a-zA-Z0-9+.\-]*://([^/?#:]*)", 1))


def origin(url: Column) -> Column:
    return F.regexp_extract(_text(url), r"^([a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]+)", 1)


def path(url: Column) -> Column:
    return F.regexp_extract(_text(url), r"^(?:[a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*)?([^?#]*)", 1)


def path_parts(url: Column) -> Column:
    return F.filter(F.split(path(url), "/"), lambda p: p != "")


def query_value(url: Column, key: str) -> Column:
    """The decoded value of a query parameter; empty where it is missing or cannot be decoded."""
    return F.coalesce(F.try_url_decode(F.regexp_extract(_text(url), rf"[?&]{key}=([^&#]*)", 1)), F.lit(""))


def under(host: Column, suffixes: Iterable[str]) -> Column:
    """The host is one of the names or below one."""
    names = list(suffixes)
    if not names:
        return F.lit(False)
    return F.exists(F.array(*[F.lit(s) for s in names]), lambda s: (host == s) | host.endswith(F.concat(F.lit("."), s)))


def host_aliases(host: Column) -> Column:
    """Spellings under which a mirror may carry a host."""
    return F.array_distinct(F.array(host, F.translate(host, "-", "."), F.translate(host, "_", "."), F.translate(F.translate(host, "-", "."), "_", ".")))


def blocked_reason(url: Column, blocked: Iterable[str]) -> Column:
    """Why a host is blocked, or empty: it lies under a listed name, or a content network mirrors one."""
    names = sorted(blocked)

    def reason(host: Column) -> Column:
        direct = [F.when(under(host, [n]), F.lit(f"blocked domain: {n}")) for n in names]
        mirrored = [F.when(under(host, MIRRORS) & F.exists(host_aliases(host), lambda a: a.contains(n)), F.lit(f"mirror of: {n}")) for n in names]  # noqa: B023
        return F.coalesce(*direct, *mirrored, F.lit(""))

    return let(domain(url), reason)


def unwrap_redirect(url: Column) -> Column:
    """The target inside a search engine's redirect, or the address itself; canonical either way."""
    found = F.filter(F.array(*[query_value(url, k) for k in REDIRECT_KEYS]), lambda v: v.startswith("http"))
    return canonical_url(F.coalesce(F.get(found, F.lit(0)), url))


def linkedin_job_id(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(F.try_url_decode(F.replace(path(url), F.lit("+"), F.lit("%2B"))), path(url)), r"(?i)/jobs/view/[^/?#]*?(\d{7,})", 1)


def clean_apply_url(url: Column) -> Column:
    """An address for applying without tracking: the detail path of a board, the key of an Indeed job, the slug of a LinkedIn one."""
    u = canonical_url(url)
    host = domain(u)
    bare = F.regexp_replace(F.concat(F.regexp_extract(u, r"^([a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*)", 1), path(u)), r"/+$", "")
    slug = F.regexp_extract(path(u), r"(?i)/jobs/view/([^/?#]+)", 1)
    key = query_value(u, "jk")
    return (
        F.when(u == "", u)
        .when(under(host, LINKEDIN) & (slug != ""), F.concat(F.lit("https://in.linkedin.com/jobs/view/"), slug))
        .when(under(host, LINKEDIN), F.regexp_replace(u, r"[?#].*$", ""))
        .when(host.contains("indeed.com") & (key != ""), F.concat(bare, F.lit("?jk="), key))
        .when(under(host, JOB_BOARDS), bare)
        .otherwise(u)
    )


def ats_provider(url: Column) -> Column:
    return let(domain(url), lambda host: F.coalesce(*[F.when(under(host, hosts), F.lit(name)) for name, hosts in ATS_HOSTS.items()], F.lit("")))


def _board(url: Column) -> Column:
    first = F.coalesce(F.get(path_parts(url), F.lit(0)), F.lit(""))
    return F.struct(domain(url).alias("host"), first.alias("first"), ats_provider(url).alias("provider"), canonical_url(url).alias("url"))


def _identifier(b: Column) -> Column:
    label = F.regexp_extract(b["host"], r"^([^.]*)", 1)
    at = {
        "path": b["first"],
        "label": F.when(label.isin(*COMMON_LABELS), "").otherwise(label),
        "host": b["host"],
        "tenant": F.regexp_replace(b["host"], r"\.[^.]+\.com$", ""),
    }
    rules: dict[tuple[str, ...], list[str]] = {}
    for name, places in ATS_IDENTIFIERS.items():
        rules.setdefault(places, []).append(name)
    return F.coalesce(*[F.when(b["provider"].isin(*names), F.coalesce(*[F.nullif(at[p], F.lit("")) for p in places], F.lit(""))) for places, names in rules.items()], F.lit(""))


def ats_identifier(url: Column) -> Column:
    """The board's identifier, from the place that ATS_IDENTIFIERS gives for its system; empty where there is none."""
    return let(_board(url), _identifier)


def ats_board_root(url: Column) -> Column:
    """One address for all pages of a board, from the forms in HOST_BOARDS and ATS_BOARDS; else the address itself."""

    def root(p: Column) -> Column:
        b, ident = p["b"], p["ident"]
        fill = lambda form: F.replace(F.replace(F.lit(form), F.lit("{id}"), ident), F.lit("{host}"), b["host"])
        own = [F.when((b["host"] == h) & (ident != ""), fill(form)) for h, form in HOST_BOARDS.items()]
        known = [F.when((b["provider"] == name) & (ident != ""), fill(form)) for name, form in ATS_BOARDS.items()]
        return F.coalesce(*own, *known, b["url"])

    return let(let(_board(url), lambda b: F.struct(b.alias("b"), _identifier(b).alias("ident"))), root)


def is_generic_careers_url(url: Column) -> Column:
    parts = path_parts(url)
    return (F.size(parts) == 0) | F.lower(F.element_at(parts, -1)).isin(CAREER_PATHS)


def source_id(url: Column) -> Column:
    return F.concat(F.lit("SRC-"), F.upper(F.substring(F.sha1(F.lower(canonical_url(url))), 1, 12)))


# fixed values: words that end the first label of a firm's host
NAME_PARTS = ("architects", "architecture", "interiors", "associates", "consultants", "designs", "design", "studio", "planners", "landscape", "engineers", "builders", "group", "works", "india", "labs", "atelier")


def company_from_domain(url: Column, suffixes: Iterable[str] = NAME_PARTS) -> Column:
    """A display name from the first label of a host: known words are split off and every word is capitalised."""
    label = F.regexp_extract(F.regexp_replace(domain(url), r"^(?:www|careers|jobs)\.", ""), r"^([^.]*)", 1)
    name = F.regexp_replace(label, r"[-_]+", " ")
    for s in suffixes:
        name = F.regexp_replace(name, rf"([a-z0-9]){s}$", rf"$1 {s}")
    return F.initcap(F.trim(name))


# fixed values: parts of an address that lead to a login
LOGIN_PARTS = ("/login", "/signin", "/sign-in", "/account/login", "/auth/login")
# fixed values: path parts of pages of content, and of pages for careers
CONTENT_PARTS = "article articles news blog blogs stories story transcript types guide guides learn education career-growth resources resource magazine project projects portfolio".split()
CAREER_PARTS = "career careers jobs job join-us joinus work-with-us workwithus openings opening vacancies vacancy hiring apply current-openings opportunities".split()
# fixed values: common paths of careers pages, and parts of an address that is one vacancy of a board
CAREER_PROBES = ("/careers", "/career", "/jobs", "/join-us", "/work-with-us", "/opportunities", "/openings")
JOB_PARTS = ("/job/", "/jobs/", "/jobdetails", "/job-detail", "/careers/", "/positions/", "/position/")
# fixed values: words of a slug where a place begins, when no name of a place is given
SLUG_PLACES = "mumbai delhi bangalore bengaluru hyderabad pune chennai noida gurugram gurgaon ahmedabad india".split()


def login_gated(url: Column, parts: Iterable[str] = LOGIN_PARTS) -> Column:
    """The address leads to a login."""
    low = F.lower(_text(url))
    return F.exists(F.array(*[F.lit(p.lower()) for p in parts]), lambda p: low.contains(p))


def careerish(url: Column) -> Column:
    """The path is one of careers or of a vacancy, and none of content."""
    parts = F.filter(F.split(F.lower(path(url)), r"[/_.]+"), lambda p: p != "")
    tail = F.replace(F.coalesce(F.try_element_at(parts, F.lit(-1)), F.lit("")), F.lit("-"), F.lit(""))
    content = F.arrays_overlap(parts, F.array(*[F.lit(p) for p in CONTENT_PARTS])) | F.lower(path(url)).rlike("career-growth|architect/types")
    own = F.arrays_overlap(parts, F.array(*[F.lit(p) for p in CAREER_PARTS])) | tail.isin(*[p.replace("-", "") for p in CAREER_PARTS])
    below = F.lower(path(url)).rlike(r"/(?:jobs?|careers?|openings?|positions?|vacanc(?:y|ies))/[^/]+")
    return (F.size(parts) > 0) & ~content & (own | below)


def career_candidates(url: Column, anchors: Column, words: Iterable[str], most: int = 12) -> Column:
    """Addresses where a firm's careers page may be, each once and in order: the page itself, links named so, then the common paths of its site.

    ``anchors``: array of (href, text), absolute.
    """
    named = F.filter(anchors, lambda a: F.exists(F.array(*[F.lit(w) for w in words]), lambda w: F.lower(a["text"]).contains(w) | F.lower(a["href"]).contains(F.replace(w, F.lit(" "), F.lit("-")))))
    links = F.transform(named, lambda a: canonical_url(a["href"]))
    own = F.when(careerish(url), F.array(canonical_url(url))).otherwise(F.array().cast("array<string>"))
    probes = F.array(*[F.concat(origin(url), F.lit(p)) for p in CAREER_PROBES])
    return F.slice(F.filter(F.array_distinct(F.concat(own, links, probes)), lambda u: u.startswith("http")), 1, most)


def urls_in_text(blob: Column) -> Column:
    """Absolute addresses in a text of any kind, such as scripts, in order and each once; escaped slashes and encoded addresses are read as meant."""
    flat = F.replace(F.replace(F.coalesce(blob, F.lit("")), F.lit("&amp;"), F.lit("&")), F.lit("\\/"), F.lit("/"))
    plain = F.regexp_extract_all(flat, F.lit(r"(?i)https?://[^\s\"'<>\\)\]}]+"), F.lit(0))
    encoded = F.transform(F.regexp_extract_all(flat, F.lit(r"(?i)https?%3A%2F%2F[^\s\"'<>\\)\]}&]+"), F.lit(0)), lambda u: F.coalesce(F.try_url_decode(u), u))
    return F.array_distinct(F.transform(F.concat(plain, encoded), lambda u: canonical_url(F.regexp_replace(u, r"[.,;]+$", ""))))


def slug_words(url: Column, places: Iterable[str] = SLUG_PLACES, most: int = 5) -> Column:
    """(title, firm) from a slug that only runs on: its first words up to a place are the title, the next the firm."""
    last = F.coalesce(F.try_element_at(path_parts(url), F.lit(-1)), F.lit(""))
    slug = F.regexp_replace(F.regexp_replace(F.coalesce(F.try_url_decode(last), last), r"^job-listings-", ""), r"(?i)[-_](?:\d{4,}|[a-f0-9]{8,}).*$", "")
    words = F.filter(F.split(slug, r"[-_]+"), lambda w: (w != "") & ~w.rlike(r"^\d+$"))
    at = F.array_min(F.filter(F.transform(F.array(*[F.lit(p) for p in places]), lambda p: F.array_position(F.transform(words, F.lower), p)), lambda n: n > 0))
    named = F.slice(words, F.lit(1), F.coalesce(at - 1, F.size(words)).cast("int"))
    join = lambda a: F.initcap(F.array_join(a, " "))
    return F.struct(join(F.slice(named, 1, most)).alias("title"), join(F.slice(named, most + 1, most)).alias("firm"))


def identity_key(url: Column, title: Column, company: Column, place: Column, email: Column) -> Column:
    """What tells a vacancy apart from all others: its number at LinkedIn, its address at a board, else what it says."""
    u, said = clean_apply_url(url), F.concat_ws("|", *[F.lower(F.trim(F.coalesce(c, F.lit("")))) for c in (title, company, place, email)])
    number, query = linkedin_job_id(u), F.lower(F.regexp_extract(u, r"\?([^#]*)", 1))
    board = F.concat(F.lit("board:"), domain(u), F.lit(":"), F.regexp_replace(F.lower(path(u)), r"/+$", ""), F.lit(":"), query)
    return F.when(under(domain(u), LINKEDIN) & (number != ""), F.concat(F.lit("linkedin:"), number)).when(under(domain(u), (*JOB_BOARDS, *LINKEDIN)), board).otherwise(F.concat(F.lit("text:"), F.sha1(said)))
