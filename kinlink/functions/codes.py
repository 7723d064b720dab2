"""Code lists and constants of the records domain.

Everything in the block below is a FIXED VALUE: it has to equal the
published HMIS coding and the reference behaviour for results to agree.
Lists are in natural (ascending code) order.
"""

# ---------------------------------------------------------------------------
# FIXED VALUES
# ---------------------------------------------------------------------------

# Codes meaning "don't know / refused / not collected" in categorical columns.
UNKNOWN_CODES = [8, 9, 99]

# Name tokens that mark a record as not a real name (lower-case, substring).
NAME_EXCLUSION = ["consent", "refused", "anonymous", "client", "refsued",
                  "noname", "unknown"]

# Upper-case name tokens removed before linkage.
REFUSED_NAME_TOKENS = ["REFUSED", "ANONYMOUS"]

# Exit destination list ("New Standards"):
# (code, description, group, success, subsidy)
DESTINATIONS = [
    (15, "Foster care home or foster care group home", "Institutional", "Other Exit", "No"),
    (6, "Hospital or other residential non-psychiatric medical facility", "Institutional", "Other Exit", "No"),
    (7, "Jail, prison or juvenile detention facility", "Institutional", "Other Exit", "No"),
    (4, "Psychiatric hospital or other psychiatric facility", "Institutional", "Other Exit", "No"),
    (5, "Substance abuse treatment facility or detox center", "Institutional", "Other Exit", "No"),
    (29, "Residential project or halfway house with no homeless criteria", "Institutional", "Other Exit", "No"),
    (8, "Client doesn't know", "Other", "Other Exit", "No"),
    (9, "Client refused", "Other", "Other Exit", "No"),
    (99, "Data not collected", "Other", "Other Exit", "No"),
    (24, "Deceased", "Other", "Other Exit", "No"),
    (30, "No exit interview completed", "Other", "Other Exit", "No"),
    (17, "Other", "Other", "Other Exit", "No"),
    (1, "Emergency shelter, including hotel or motel paid for with emergency shelter voucher", "Temporary", "Other Exit", "No"),
    (14, "Hotel or motel paid for without emergency shelter voucher", "Temporary", "Other Exit", "No"),
    (16, "Place not meant for habitation (e.g., a vehicle, an abandoned building, bus/train/subway station/airport or anywhere outside)", "Temporary", "Other Exit", "No"),
    (27, "Moved from one HOPWA funded project to HOPWA TH", "Temporary", "Other Exit", "No"),
    (18, "Safe Haven", "Temporary", "Other Exit", "No"),
    (12, "Staying or living with family, temporary tenure (e.g., room, apartment or house)", "Temporary", "Other Exit", "No"),
    (13, "Staying or living with friends, temporary tenure (e.g., room, apartment or house)", "Temporary", "Other Exit", "No"),
    (2, "Transitional housing for homeless persons (including homeless youth)", "Temporary", "Other Exit", "No"),
    (25, "Long-term care facility or nursing home", "Permanent", "Successful Exit", "No"),
    (26, "Moved from one HOPWA funded project to HOPWA PH", "Permanent", "Successful Exit", "Yes"),
    (11, "Owned by client, no ongoing housing subsidy", "Permanent", "Successful Exit", "No"),
    (21, "Owned by client, with ongoing housing subsidy", "Permanent", "Successful Exit", "Yes"),
    (3, "Permanent housing for formerly homeless persons (such as: CoC project; or HUD legacy programs; or HOPWA PH)", "Permanent", "Successful Exit", "Yes"),
    (10, "Rental by client, no ongoing housing subsidy", "Permanent", "Successful Exit", "No"),
    (28, "Rental by client, with GPD TIP housing subsidy", "Permanent", "Successful Exit", "Yes"),
    (20, "Rental by client, with other ongoing housing subsidy", "Permanent", "Successful Exit", "Yes"),
    (19, "Rental by client, with VASH housing subsidy", "Permanent", "Successful Exit", "Yes"),
    (22, "Staying or living with family, permanent tenure", "Permanent", "Successful Exit", "No"),
    (23, "Staying or living with friends, permanent tenure", "Permanent", "Successful Exit", "No"),
]

# Project (program) types.
PROJECT_TYPES = [
    (1, "Emergency Shelter"),
    (2, "Transitional Housing"),
    (3, "PH - Permanent Supportive Housing (disability required for entry)"),
    (4, "Street Outreach"),
    (5, "Legacy HPRP"),
    (6, "Services Only"),
    (7, "Other Programs"),
    (8, "Safe Haven"),
    (9, "PH - Housing Only"),
    (10, "PH - Housing with Services (no disability required for entry)"),
    (11, "Day Shelter"),
    (12, "Homelessness Prevention"),
    (13, "PH - Rapid Re-Housing"),
    (14, "Coordinated Assessment"),
]

# Disability types.
DISABILITY_TYPES = [
    (5, "Physical"),
    (6, "Developmental"),
    (7, "ChronicHealth"),
    (8, "HIVAIDS"),
    (9, "MentalHealth"),
    (10, "SubstanceAbuse"),
]

# HMIS gender codes 0-4.
HMIS_GENDER = [(0, "Fem"), (1, "Mal"), (2, "MTF"), (3, "FTM"), (4, "GNC")]

# Housing-authority gender text.
PHA_GENDER = [("Female", "Fem"), ("Male", "Mal")]

# Race category labels of the housing-authority extract.
RACE_ONLY = [("r_aian", "AIAN only"), ("r_asian", "Asian only"),
             ("r_black", "Black only"), ("r_nhpi", "NHPI only"),
             ("r_white", "White only")]
RACE_MULTI = "Multiple race"

# Housing-authority agencies.
PHA_AGENCIES = ["KCHA", "SHA"]

# HMIS project types whose open spells get a 90-day exit.
SHORT_STAY_PROJECTS = ["Day Shelter", "Emergency Shelter",
                       "Homelessness Prevention", "Other Programs",
                       "Services Only", "Street Outreach"]

# Relationship codes treated as missing.
RELCODE_MISSING = ["", "99", "D", "M", "N"]

# Relationship codes that mark a child when age < 18.
RELCODE_CHILD = ["Y", "F", "2"]

# Default stage suffixes.
ENTRY_EXIT_SUFFIX = ["_entry", "_exit", "_update"]

# Default thresholds.
MATCH_THRESHOLD = 0.5
STRING_THRESHOLD = 0.85
CONFLICT_WINDOW_DAYS = 365
EARLIEST_BIRTH_DATE = "1900-01-01"
BAD_DOB_MIN_YEAR = 1900
BAD_DOB_MAX_YEAR = 2018
BAD_DOB_FREQ_PHA = 64
BAD_DOB_FREQ_HMIS = 81
SPELL_MIN_ENTRY = "2004-01-01"
OPEN_SPELL_END = "2017-12-31"
SHORT_STAY_DAYS = 90
AGE_MAX = 120
CHILD_AGE = 18
CHILD_AGE_CAP = 25
ELDER_AGE = 62
DAYS_PER_YEAR = 365.25

# ---------------------------------------------------------------------------
# end of fixed values
# ---------------------------------------------------------------------------
