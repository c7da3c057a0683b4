"""Ordered rewrites of text: rules are data, compiled to one Catalyst expression or to SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

Rules = list[tuple[str, str]]

# Fixed values. Each rule is (pattern, replacement); a rule sees what the rules before it left.
STANDARD_NAME: Rules = [
    (r" & ", " AND "),
    (r"#", "NUMBER"),
    (r" NO ", " NUMBER "),
    (r"[.']", ""),
    (r",\s*,+", ","),
    (r"\?", ""),
    (r" ,", ","),
]
NAME_TYPOS: Rules = [
    ("ENTITITES", "ENTITIES"),
    ("ENTITES", "ENTITIES"),
    ("COMMITTE ", "COMMITTEE "),
    ("CAMMITTEE", "COMMITTEE"),
    ("VACINITY", "VICINITY"),
    ("AND AFFILIATES ENTITIES", "AND AFFILIATED ENTITIES"),
]
BUSINESS_WORDS: Rules = [
    (r"[^\p{L}\p{N} ()]", " "),
    (r" LTD LLLP$", ""),
    (r" AND AFFILIATED (?:ENTITIES|COMPANIES|ENTITIES INC)$", ""),
    (r" AND AFFILIATED$", ""),
    (r"AND (?:ITS )?SUBSIDIARIES", ""),
    (r" ASSOC ", " ASSOCIATION "),
    (r" LTD LLC$", ""),
    (r" CORP$", ""),
    (r" INC$", ""),
    (r" INCORPORATED$", ""),
    (r" LLC$", ""),
    (r" LTD$", ""),
    (r" LLP$", ""),
    (r" LP$", ""),
    (r" PA$", ""),
    (r" AND CO$", ""),
    (r" CO$", ""),
    (r"COMPANY$", ""),
    (r"MGMT", "MANAGEMENT"),
]
COMMITTEE_WORDS: Rules = [
    (r"POLITICAL ACTION LEAGUE(?: FOR)?", ""),
    (r"POLITICAL ACTION COMMITTEE(?: STATE PAC)?", ""),
    (r"POLITICAL ACTION CO$", ""),
    (r"POLITICAL (?:ACTION )?FUND", ""),
    (r"PAC ALL PURPOSE", ""),
    (r"SCC", ""),
    (r"SMALL (?:CONTRIBUTOR |CONT )?COMMITTEE", ""),
    (r"PAC FED PAC", ""),
    (r" STATE PAC$", ""),
    (r"(?:STATEWIDE|FEDERAL) PAC$", ""),
    (r"(?:\s+(?:FED\s+PAC|PAC))+$", ""),
    (r"MAJOR DONOR(?: ACCOUNT| COMMITTEE)?", ""),
    (r"FPPC", ""),
]
COMMITTEE_IDS: Rules = [
    (r"FED\s*ID\s*NUMBER\s*C\d+", ""),
    (r"\s*\([^)]*(?:ID|FPPC|FEC)[^)]*\)", ""),
    (r"\s*(?:ID(?:\s*NUMBER)?|FPPC|FEC)\s*[A-Z0-9]+$", ""),
]
UNIT_NUMBERS: Rules = [
    (r"(?i)\s+LOCAL(?:\s+UNION)?(?:\s+NO|\s+NUMBER)?\s*\d+", ""),
    (r"(?i)\s+NUMBER\s*\d+", ""),
]
WORK_STATUS: Rules = [
    (r"^(?:N/A|NA|N A)$", "NONE"),
    (r"^(?:BLANK|NONE OF YOUR BUSINESS|PREFER NOT TO DISCLOSE)$", "UNKNOWN"),
    (r"^(?:NOT EMPLOYED|NONE) \(RETIRED\)$", "RETIRED"),
    (r"^(?:NOT EMPLOYED|NONE)-RETIRED$", "RETIRED"),
    (r"^RETIRED NONE$", "RETIRED"),
    (r"^RETIRED NOT EMPLOYED", "RETIRED"),
    (r"^(?:NOT EMPLOYED|UNEMPLOYED|NO|NOT EMPOYED|NOT EMLOYED|NOT-EMPLOYED|NOT RMPLOYED|NOT EMPLOYYED|A, N /)$", "NONE"),
    (r"SELF-EMPLOYED", "SELF EMPLOYED"),
    (r"CHIEF EXECUTIVE OFFICER", "CEO"),
    (r"CHIEF TECHNOLOGY OFFICER", "CTO"),
    (r"CHIEF OPERATING OFFICER", "COO"),
    (r"CHIEF FINANCIAL OFFICER", "CFO"),
    (r"EXEC ", "EXECUTIVE "),
    (r"EXEC$", "EXECUTIVE"),
    (r"^INFORMATION REQUESTED$", "UNKNOWN"),
    (r"INFORMATION REQUESTED-?\s*", ""),
]
CITY: Rules = [(r",.*$", ""), (r"\s+\d{5}(?:-\d{4})?$", ""), (r"[^A-Za-z0-9 ]", "")]
STATE: Rules = [(r"\s+\d{5}(?:-\d{4})?$", ""), (r"[^A-Za-z0-9 ]", "")]
CORPORATE_SUFFIX: Rules = [(r"(?i)[\s,]+(?:INC|LLC|L\.?L\.?C|CORP|CORPORATION|CO|COMPANY|LTD|LP|LLP)\.?$", "")]
SHORT_WORDS: Rules = [
    (r"\bassn\b", "association"),
    (r"\bassoc\b", "association"),
    (r"\bmgmt\b", "management"),
    (r"\bmfg\b", "manufacturing"),
    (r"\bintl\b", "international"),
    (r"\bnatl\b", "national"),
    (r"\bsvcs\b", "services"),
    (r"\bsvc\b", "service"),
    (r"\bdept\b", "department"),
    (r"\buniv\b", "university"),
    (r"\bgovt\b", "government"),
    (r"\bdist\b", "district"),
    (r"\bhosp\b", "hospital"),
    (r"\bctr\b", "center"),
    (r"\bengr\b", "engineer"),
    (r"\bmgr\b", "manager"),
    (r"\batty\b", "attorney"),
]


def squish(c: Column) -> Column:
    """Runs of white space as one blank, none at the ends."""
    return F.trim(F.regexp_replace(c, r"[\s\x{a0}]+", " "))


#: White space at the ends, no-break spaces included.
_ENDS = r"^[\s\x{a0}]+|[\s\x{a0}]+$"


def strip(c: Column) -> Column:
    """c without white space at its ends; trim() alone would leave tabs, line ends and no-break spaces."""
    return F.regexp_replace(c, _ENDS, "")


def strip_sql(e: str) -> str:
    """The SQL that equals strip()."""
    return f"regexp_replace({e}, '{_ENDS}', '', 'g')"


def rewritten(c: Column, rules: Rules) -> Column:
    """c with the rules applied in order; null stays null."""
    return reduce(lambda x, rule: F.regexp_replace(x, rule[0], rule[1]), rules, c)


def squish_sql(e: str) -> str:
    return f"trim(regexp_replace({e}, '[\\s\\x{{a0}}]+', ' ', 'g'))"


def rewritten_sql(e: str, rules: Rules) -> str:
    """The SQL that equals rewritten()."""
    for pattern, new in rules:
        e = "regexp_replace({}, '{}', '{}', 'g')".format(e, pattern.replace("'", "''"), new)
    return e
