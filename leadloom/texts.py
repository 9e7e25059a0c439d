"""Texts of verdicts and questions.

The values below are fixed values: stored rationales and questions are only right when they read
exactly like this. Parts that are filled in stand between them.
"""

# --- fixed values: company verdicts ----------------------------------------------------------------
OFFLINE_FIT = "[offline heuristic] "
NO_COUNT = "None"
OUTSIDE_BAND = (" employees is outside the ICP ", " band; dropped on size before website research.")
DISQUALIFIED = ("LinkedIn signals a disqualified category (", ").")
ON_TARGET = (
    "LinkedIn industry/specialties match ICP biotech/pharma signals (", "); hiring in-scope EU locations (", ").",
)
NO_PLACES = "EU"
OUT_OF_SCOPE = "Industry matches ICP but no in-scope EU/EEA/UK/CH/Norway hiring location was seen."
NO_SIGNAL = "LinkedIn metadata does not clearly match the ICP target industries."
NO_RATIONALE = "No rationale returned."

# --- fixed values: person verdicts -----------------------------------------------------------------
OFFLINE_PERSON = "[offline] "
JUNIOR = "is a peer/junior-level role, not the decision-maker for this requisition."
LEADER = "is a function head/leader who plausibly owns this hiring decision."
SMALL_TALENT = "Talent leader at a sub-200 company owns hiring end-to-end."
LARGE_TALENT = "Generic talent role is outranked by the functional head at this size."
NO_AUTHORITY = "does not indicate decision-maker authority."
NO_MATCH = "no plausible decision-maker match"
NO_REASON = "No reason returned."

# --- fixed values: question on a company, label by label -------------------------------------------
FIT_QUESTION = (
    "Company: ",
    "\nLinkedIn industry: ",
    "\nEmployees (LinkedIn, may be a LOCAL/subsidiary entity not the global group): ",
    "\nHeadquarters: ",
    "\nSpecialties: ",
    "\nLinkedIn description: ",
    "\nJob locations seen in scrape: ",
    "\n\nResearch this company's website and decide ICP fit. Return the JSON object.",
)
UNKNOWN = "unknown"
NOT_AVAILABLE = "n/a"

# --- fixed values: question on a person and a posting, label by label ------------------------------
PERSON_QUESTION = (
    "SCRAPED JOB\n-----------\nTitle:        ",
    "\nLocation:     ",
    "\nCompany:      ",
    "\nCompany size: ",
    "\nDescription (first ~500 chars):\n",
    "\n\nCANDIDATE PERSON\n----------------\nFull name:     ",
    "\nCurrent title: ",
    "\nLocation:      ",
    "\nAbout:         ",
    "\n\nCould this person plausibly be the hiring manager or final decision-maker for this specific role?",
)
