"""Text functions: Column in, Column out, all inside whole-stage code generation. Null in, null out unless stated."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyloom.functions import rewrites as R

# Words and marks that tell organisations, people and committees apart.
ORGANISATION_WORDS = (
    "INC LLC CORP INCORPORATED CORPORATION COMPANY LTD LLP PLC PARTNERSHIP LTC MGMT MANAGEMENT SERVICES ENTITIES LP ASSOCIATION ASSOC ASSN AFFILIATED "
    "AFFILIATES PAC COMMITTEE UNION POLITICAL ACTION FPPC LOCAL FUND GROUP PARTNERS ENGINEERING ARCHITECTS CONSULTING CONSTRUCTION ATTORNEYS SOLUTIONS "
    "INDUSTRIES PC APC FIRM"
).split()
NAME_MARKS = (
    "JR SR I II III IV MD PHD ESQ DDS DO DR MR MRS MS HON EDS OD CPA DVM RN NP FACS TTEE JD MBA CFA ND CRNA NMD DMD DC MAJ COL CAPT GEN LT LTC ADM SGT "
    "CPT CDR ENS SFC COMMANDER USAF USA USN USMC USCG RET RETD"
).split()
NAME_TITLES = "DR MR MRS MS MAJ COL CAPT GEN LT LTC ADM SGT CPT CDR".split()
COMMITTEE_LANGUAGE = (
    "PAC|POLITICAL ACTION COMMITTEE|POLITICAL ACTION LEAGUE|POLITICAL FUND|POLITICAL ACTION FUND|COMMITTEE|FPPC|SCC|SMALL CONTRIBUTOR|INDEP EXPENDITURE|INDEPEDENT EXPENDITURE"
)
NO_EMPLOYER = ("", "N/A", "NA", "NONE", "NAN", "NULL", "UNKNOWN", "NOT EMPLOYED", "UNEMPLOYED", "RETIRED", "SELF", "SELF EMPLOYED", "SELF-EMPLOYED", "INFORMATION REQUESTED", "HOMEMAKER", "STUDENT")

ORGANISATION = r"\b(?:" + "|".join(ORGANISATION_WORDS) + r"|AND CO)\b"


def _at(array: Column, place: int) -> Column:
    """An array's element, null where there is none."""
    return F.try_element_at(array, F.lit(place))


def normalize_name(c: Column) -> Column:
    """Upper case, everything but A-Z, 0-9 and blanks as a blank, squeezed; null gives ''."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.upper(F.coalesce(c, F.lit(""))), "[^A-Z0-9 ]+", " "), " +", " "))


def standardize_name(c: Column) -> Column:
    return R.squish(R.rewritten(F.upper(c), R.STANDARD_NAME))


def fix_typos(c: Column) -> Column:
    return R.squish(R.rewritten(F.upper(c), R.NAME_TYPOS))


def business_core(c: Column) -> Column:
    """A standardised name without its legal form."""
    return R.squish(R.rewritten(c, R.BUSINESS_WORDS))


def committee_core(c: Column) -> Column:
    """A committee's name without committee language and ids."""
    return R.squish(R.rewritten(R.rewritten(c, R.COMMITTEE_IDS), R.COMMITTEE_WORDS))


def without_units(c: Column) -> Column:
    return R.squish(R.rewritten(c, R.UNIT_NUMBERS))


def work_status(c: Column) -> Column:
    """An occupation or employer with its many ways to say none, unknown and retired made one."""
    return R.squish(R.rewritten(F.upper(c), R.WORK_STATUS))


def standardize_city(c: Column) -> Column:
    return R.squish(R.rewritten(F.upper(F.regexp_replace(c, r"\s+[A-Z]{2}$", "")), R.CITY))


def standardize_state(c: Column) -> Column:
    return R.squish(R.rewritten(F.upper(c), R.STATE))


def without_parentheses(c: Column) -> Column:
    return F.regexp_replace(c, r"\s*\([^)]*\)", "")


def without_corporate_suffix(c: Column) -> Column:
    return R.rewritten(c, R.CORPORATE_SUFFIX)


def without_candidate_tail(c: Column) -> Column:
    """', SUPPORTING X FOR GOVERNOR' and its like dropped; the whole name if nothing else is in it."""
    short = F.trim(F.regexp_replace(c, r"(?i)[,;(]?\s*\b(?:SUPPORTING|OPPOSING|SPONSORED BY|IN SUPPORT OF)\b.*$", ""))
    return F.when(short == "", c).otherwise(short)


def expanded_words(c: Column) -> Column:
    """Lower case with common short forms written out and punctuation as blanks."""
    return R.squish(R.rewritten(F.regexp_replace(F.lower(c), r"[^a-z0-9 ]+", " "), R.SHORT_WORDS))


def joined_name(last: Column, first: Column) -> Column:
    """'LAST, FIRST', or the one there is; '' without either."""
    a, b = F.trim(F.coalesce(last, F.lit(""))), F.trim(F.coalesce(first, F.lit("")))
    return F.when(a == "", b).when(b == "", a).otherwise(F.concat(a, F.lit(", "), b))


def split_keywords(c: Column) -> Column:
    """Keywords parted by commas and slashes: trimmed, in lower case, none blank."""
    return F.filter(F.transform(F.split(F.lower(c), "[,/]"), R.strip), lambda x: x != "")


def is_organisation(c: Column) -> Column:
    """A name with an organisation's word, or without a comma."""
    up = F.upper(F.coalesce(c, F.lit("")))
    return up.rlike(ORGANISATION) | ~up.contains(",")


def has_committee_language(c: Column) -> Column:
    return F.upper(F.coalesce(c, F.lit(""))).rlike(r"\b(?:" + COMMITTEE_LANGUAGE + r")\b")


def _clean_person(c: Column) -> Column:
    up = R.squish(F.regexp_replace(F.upper(F.coalesce(c, F.lit(""))), r"[`@#$%\\^*_=\[\]{}|<>]", ""))
    bare = F.regexp_replace(R.squish(F.regexp_replace(up, r"\s*\([^)]*\)", "")), r"([A-Z])\.", "$1")
    return R.squish(F.regexp_replace(F.regexp_replace(bare, r"\+", " AND "), "/", "-"))


def is_individual(c: Column) -> Column:
    """Whether a name reads as a person's: 'LAST, FIRST', with marks and titles before, between or after; never a firm of partners."""
    name = _clean_person(c)
    parts = F.filter(F.transform(F.split(name, ","), lambda x: F.trim(x)), lambda x: x != "")
    n = F.size(parts)
    first, last = _at(parts, 1), F.when(n > 0, _at(parts, -1))
    middle = F.slice(parts, 2, F.greatest(n - 2, F.lit(0)))
    words, dotted, mark = r"^[A-Z'\- ]+$", r"^[A-Z'\-. ]+$", r"^(?:(?:" + "|".join(NAME_MARKS) + r"|[A-Z])(?:\s+|$))+$"
    few = F.forall(parts, lambda x: x.rlike(dotted) & (F.size(F.split(x, r"\s+")) <= 3) & ~x.rlike(r"\bAND\b"))
    two = (n == 2) & first.rlike(words) & last.rlike(dotted)
    more = (n >= 3) & first.rlike(words) & (
        (last.rlike(dotted) & F.forall(middle, lambda x: x.rlike(mark)))
        | (last.rlike(mark) & F.forall(middle, lambda x: x.rlike(dotted)))
        | ((n == 3) & few & (F.size(F.split(first, r"\s+")) <= 2))
    )
    joint = name.rlike(r"^[^,]*,[^,]*\bAND\b")
    return ~F.upper(F.coalesce(c, F.lit(""))).rlike(ORGANISATION) & ~name.rlike(ORGANISATION) & F.coalesce(joint | two | more, F.lit(False))


def person_name(c: Column) -> Column:
    """struct(last, first, middle, suffix, title) of 'LAST, [SUFFIX,] [TITLE] FIRST [MIDDLE] [SUFFIX]'; nulls where a part is absent."""
    bare = R.squish(F.regexp_replace(F.regexp_replace(F.upper(c), r"\s*\([^)]*\)", ""), r"\.", ""))
    parts = F.filter(F.transform(F.split(bare, ","), lambda x: F.trim(x)), lambda x: x != "")
    blank = lambda x: F.when(x != "", x)
    is_mark = lambda x: x.isin(NAME_MARKS)
    head = F.filter(F.split(F.when(F.size(parts) > 0, _at(parts, 1)), r"\s+"), lambda x: x != "")
    head_mark = (F.size(head) > 1) & is_mark(_at(head, -1))
    last = F.when(head_mark, F.array_join(F.slice(head, 1, F.size(head) - 1), " ")).otherwise(F.array_join(head, " "))
    rest = F.slice(parts, 2, F.greatest(F.size(parts), F.lit(1)))
    all_marks = lambda p: p.rlike(r"^(?:(?:" + "|".join(NAME_MARKS) + r")(?:\s+|$))+$")
    tokens = F.filter(F.flatten(F.transform(F.filter(rest, lambda p: ~all_marks(p)), lambda p: F.split(p, r"\s+"))), lambda x: x != "")
    joint = F.array_contains(tokens, "AND")
    title = F.when(~joint & (F.size(tokens) > 1) & _at(tokens, 1).isin(NAME_TITLES), _at(tokens, 1))
    named = F.when(title.isNotNull(), F.slice(tokens, 2, F.size(tokens))).otherwise(tokens)
    plain = F.when(F.size(named) > 1, F.concat(F.slice(named, 1, 1), F.filter(F.slice(named, 2, F.size(named)), lambda x: ~is_mark(x)))).otherwise(named)
    trailing = F.filter(F.slice(named, 2, F.greatest(F.size(named), F.lit(1))), is_mark)
    marks = F.concat(
        F.when(head_mark, F.array(_at(head, -1))).otherwise(F.array().cast("array<string>")),
        F.filter(rest, all_marks),
        F.when(joint, F.array().cast("array<string>")).otherwise(trailing),
    )
    first = F.when(joint, F.array_join(tokens, " ")).when(F.size(plain) > 0, _at(plain, 1))
    middle = F.when(~joint & (F.size(plain) > 1), F.array_join(F.slice(plain, 2, F.size(plain)), " "))
    return F.struct(blank(last).alias("last"), first.alias("first"), middle.alias("middle"), blank(F.array_join(marks, " ")).alias("suffix"), title.alias("title"))


def is_junk_employer(employer: Column, name: Column) -> Column:
    """An employer that names none: a placeholder, no letters, or the donor's own name."""
    up = normalize_name(employer)
    own = normalize_name(F.regexp_extract(F.coalesce(name, F.lit("")), r"^([^,]*)", 1))
    return up.isin([x.replace("/", " ").replace("-", " ") for x in NO_EMPLOYER]) | ~up.rlike("[A-Z]") | ((own != "") & (up == normalize_name(name)))


def clean_key(c: Column) -> Column:
    """A text in lower case without blanks around it; null if nothing is left."""
    return F.nullif(R.strip(F.lower(c)), F.lit(""))


def embed_text(occupation: Column, employer: Column, name: Column) -> Column:
    """The text a donor is encoded by: 'occupation at employer', whichever there is, else the name."""
    o, e = F.nullif(R.strip(F.lower(occupation)), F.lit("")), F.nullif(R.strip(F.lower(employer)), F.lit(""))
    return F.when(o.isNotNull() & e.isNotNull(), F.concat(o, F.lit(" at "), e)).otherwise(F.coalesce(o, e, F.lower(name)))


def size_lower_bound(c: Column) -> Column:
    """'1,000-4,999 employees' as 1000; -1 if no number is in it."""
    digits = F.regexp_replace(F.regexp_extract(F.coalesce(c, F.lit("")), r"(\d[\d,]*)", 1), ",", "")
    return F.coalesce(F.when(digits != "", digits).cast("bigint"), F.lit(-1).cast("bigint"))


def json_object(c: Column) -> Column:
    """The text from the first '{' to the last '}', as a model's reply may wrap it; null without one."""
    found = F.regexp_extract(c, r"(?s)(\{.*\})", 1)
    return F.when(found != "", found)


def url_domain(c: Column) -> Column:
    """The host of an address in lower case, without 'www.'; null if it has none."""
    full = F.when(c.rlike("(?i)^[a-z]+://"), c).otherwise(F.concat(F.lit("http://"), c))
    host = F.lower(F.regexp_extract(full, r"(?i)^[a-z]+://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(host != "", F.regexp_replace(host, r"^www\.", ""))


def html_description(c: Column) -> Column:
    """A page's meta description, else its og:description, else its first paragraph of more than 60 characters; 400 characters at most."""
    meta = F.regexp_extract(c, r"""(?is)<meta[^>]+name=["']description["'][^>]+content=["']([^"']*)["']""", 1)
    og = F.regexp_extract(c, r"""(?is)<meta[^>]+property=["']og:description["'][^>]+content=["']([^"']*)["']""", 1)
    paragraphs = F.transform(F.regexp_extract_all(c, F.lit(r"(?is)<p[^>]*>(.*?)</p>"), F.lit(1)), lambda p: R.squish(F.regexp_replace(p, "<[^>]+>", "")))
    long = F.filter(paragraphs, lambda p: F.length(p) > 60)
    body = F.when(F.size(long) > 0, _at(long, 1))
    return F.substring(F.coalesce(F.nullif(meta, F.lit("")), F.nullif(og, F.lit("")), body), 1, 400)
