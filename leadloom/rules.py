"""Rule values of the lead funnel, kept as data so that every operator takes them as parameters.

The values below are fixed values: results are only right when they are exactly these.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --- fixed values: posting selection -----------------------------------------------------------
TITLE_PHRASES = (
    "Regulatory Affairs Manager", "Senior Regulatory Affairs Manager", "Director Regulatory Affairs",
    "Head of Regulatory Affairs", "Regulatory Affairs Specialist", "Clinical Operations Manager",
    "Director Clinical Operations", "Head of Clinical Operations", "Senior Clinical Research Associate",
    "Clinical Trial Manager", "Clinical Project Manager", "Pharmacovigilance Manager",
    "Drug Safety Officer", "Qualified Person for Pharmacovigilance", "Medical Affairs Lead",
    "Medical Science Liaison", "Senior Medical Advisor",
)
EMPLOYMENT_TYPES = ("FULL_TIME", "CONTRACTOR")
LOCATIONS = (
    "Germany", "Switzerland", "Netherlands", "Belgium", "Denmark", "Sweden", "Ireland", "France",
    "United Kingdom", "Spain", "Italy", "Austria", "Finland", "Norway",
)
TIME_WINDOWS = {"1h": "1 hour", "24h": "24 hours", "7d": "7 days", "6m": "6 months"}
DEFAULT_WINDOW = "7d"
DEFAULT_SOURCE_ROWS = 200
MAX_SOURCE_ROWS = 5000
RECENCY_DAYS = 8

# --- fixed values: company size bands with the titles to look for, best first --------------------
SIZE_BANDS = (
    (50, 200, "50-200", (
        "Head of Talent", "Head of People", "Head of HR",
        "Director Regulatory Affairs", "Director Clinical Operations",
    )),
    (201, 1000, "201-1000", (
        "VP People", "VP Talent Acquisition", "Senior Director Regulatory Affairs",
        "Senior Director Clinical Operations", "Director Talent Acquisition Europe",
    )),
    (1001, 2000, "1001-2000", (
        "Global Head of Talent", "EU Head of Talent Acquisition", "VP Regulatory Affairs EU",
        "VP Clinical Operations EU", "Senior Director Talent Acquisition",
    )),
)

# --- fixed values: industry keywords (substring semantics) ---------------------------------------
TARGET_KEYWORDS = (
    "biotech", "biotechnology", "pharma", "pharmaceutical", "drug discovery", "drug development",
    "gene therapy", "cell therapy", "mrna", "immunotherapy", "oncology", "rare disease",
    "clinical-stage", "clinical stage", "contract research", "cro", "cdmo",
)
DISQUALIFIERS = (
    "university", "universities", "academic", "research institute", "institut", "hospital", "clinic",
    "klinik", "staffing", "recruitment", "recruiting", "consulting", "consultancy", "medical device",
    "medical devices", "cosmetic", "cosmetics", "nutraceutical", "food supplement", "supplements",
)

# --- fixed values: geography ---------------------------------------------------------------------
IN_SCOPE_COUNTRIES = (
    "germany", "switzerland", "netherlands", "belgium", "denmark", "sweden", "ireland", "france",
    "united kingdom", "spain", "italy", "austria", "finland", "norway", "iceland", "luxembourg",
    "portugal", "greece", "poland", "czechia", "czech republic", "slovakia", "slovenia", "hungary",
    "romania", "bulgaria", "croatia", "estonia", "latvia", "lithuania", "liechtenstein", "malta",
    "cyprus",
)
IN_SCOPE_CODES = (
    "de", "ch", "nl", "be", "dk", "se", "ie", "fr", "gb", "uk", "es", "it", "at", "fi", "no", "is",
    "lu", "pt", "gr", "pl", "cz", "sk", "si", "hu", "ro", "bg", "hr", "ee", "lv", "lt", "li", "mt",
    "cy",
)
REGIONS = {
    "DACH": ("germany", "austria", "switzerland"),
    "Benelux": ("belgium", "netherlands", "luxembourg"),
    "Nordics": ("denmark", "sweden", "norway", "finland", "iceland"),
    "UKI": ("united kingdom", "ireland"),
    "Southern Europe": ("spain", "italy", "portugal", "greece"),
    "Western Europe": ("france",),
}

# --- fixed values: client matching ---------------------------------------------------------------
CLIENTS = (
    "Pfizer", "Bayer", "Novartis", "Roche", "Sanofi", "GSK", "GlaxoSmithKline", "AstraZeneca",
    "Merck KGaA", "Boehringer Ingelheim", "BioNTech", "CureVac", "MorphoSys", "Evotec", "ICON",
    "ICON plc", "IQVIA",
)
LEGAL_SUFFIXES = (
    "& co kg", "sas", "spa", "sa", "nv", "gmbh", "ag", "se", "inc", "ltd", "llc", "plc", "ab", "oyj",
    "oy", "a/s", "holding", "holdings", "group", "corporation", "corp", "co", "company",
    "international",
)
TWO_PART_SUFFIXES = ("co.uk", "ac.uk", "org.uk", "com.au", "co.jp", "com.br")
MIN_FUZZY_LEN = 5
MAX_EDITS = 2
MIN_RATIO = 90

# --- fixed values: people ------------------------------------------------------------------------
RANK_LEADER_WORDS = ("head", "chief", "vp", "vice president", "director", "global", "lead", "president")
RANK_DOMAIN_WORDS = (
    "talent", "people", "hr", "human resources", "regulatory", "clinical", "operations", "medical",
    "affairs",
)
LEADER_WORDS = ("head", "chief", "vp", "vice president", "director", "global head", "lead", "principal")
TALENT_WORDS = ("talent", "people", "hr", "human resources", "recruit")
JUNIOR_WORDS = ("associate", "assistant", "coordinator", "specialist", "junior", " ii", "intern")
PEOPLE_PER_COMPANY = 2
PROVIDER = "prospeo"
CASCADE_LEVEL = "company"
SMALL_BAND = "50-200"


@dataclass(frozen=True)
class Rules:
    """All rule values of one run; replace single fields to run with other rules."""

    title_phrases: tuple = TITLE_PHRASES
    employment_types: tuple = EMPLOYMENT_TYPES
    locations: tuple = LOCATIONS
    size_bands: tuple = SIZE_BANDS
    target_keywords: tuple = TARGET_KEYWORDS
    disqualifiers: tuple = DISQUALIFIERS
    in_scope_countries: tuple = IN_SCOPE_COUNTRIES
    in_scope_codes: tuple = IN_SCOPE_CODES
    regions: dict = field(default_factory=lambda: dict(REGIONS))
    clients: tuple = CLIENTS
    min_fuzzy_len: int = MIN_FUZZY_LEN
    max_edits: int = MAX_EDITS
    min_ratio: int = MIN_RATIO
    rank_leader_words: tuple = RANK_LEADER_WORDS
    rank_domain_words: tuple = RANK_DOMAIN_WORDS
    leader_words: tuple = LEADER_WORDS
    talent_words: tuple = TALENT_WORDS
    junior_words: tuple = JUNIOR_WORDS
    people_per_company: int = PEOPLE_PER_COMPANY
    provider: str = PROVIDER
    cascade_level: str = CASCADE_LEVEL
    small_band: str = SMALL_BAND
    whole_words: bool = False


DEFAULT_RULES = Rules()
