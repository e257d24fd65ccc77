"""The four space-object contracts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import types as T

from starledger.operators.contracts import Contract, Field, Rule

TEXT, DATE, FLAG = T.StringType(), T.DateType(), T.BooleanType()
INT, REAL = T.LongType(), T.DoubleType()

# Designator pattern, earliest date and code lists.
# (\z: Java's $ would also accept a trailing line feed.)
DESIGNATOR = r"^\d{4,5}-[A-Z0-9*\- ]+\z"
EARLIEST = dt.date(1957, 10, 4)
CLASSIFICATIONS = ("U", "C", "S")
OBJECT_TYPES = ("PAY", "R/B", "DEB", "UNK")
OPERATION_CODES = ("+", "-", "P", "B", "S", "X", "D", "p")
DATA_CODES = ("NEA", "NIE", "NCE")
ORBIT_TYPES = ("ORB", "IMP", "LAN", "DOC", "R/T")
REGIMES = ("LEO", "MEO", "GEO", "HEO", "unknown")
MATCH_SOURCES = ("cospar", "name_date", "fuzzy", "unmatched_unoosa", "unmatched_celestrak")
CONFIDENCES = ("high", "medium", "low")
PRESENCES = ("both", "unoosa_only", "celestrak_only")

COSPAR = (Rule("matches", DESIGNATOR),)
SPACE_AGE = (Rule("ge", EARLIEST),)
NOT_NEGATIVE = (Rule("ge", 0),)
POSITIVE = (Rule("gt", 0),)


def within(low: float, high: float) -> tuple[Rule, Rule]:
    """Both ends allowed."""
    return Rule("ge", low), Rule("le", high)


def below(low: float, high: float) -> tuple[Rule, Rule]:
    """Upper end not allowed."""
    return Rule("ge", low), Rule("lt", high)


REGISTRY = Contract(
    "registry_raw",
    "1.0.0",
    (
        Field("International Designator", TEXT, False, COSPAR),
        Field("National Designator", TEXT),
        Field("Name of Space Object", TEXT),
        Field("State of Registry", TEXT),
        Field("Date of Launch", DATE, True, SPACE_AGE),
        Field("Status", TEXT),
        Field("Date of Decay", DATE, True, SPACE_AGE),
        Field("UN Registered", FLAG),
        Field("Registration Documents", TEXT),
        Field("Function", TEXT),
        Field("Remarks", TEXT),
        Field("External website", TEXT),
    ),
    ordered=False,
    key=("International Designator",),
)

# Registry columns whose changes count in a diff.
DIFF_COLUMNS = (
    "National Designator",
    "Name of Space Object",
    "State of Registry",
    "Date of Launch",
    "Status",
    "Date of Decay",
    "UN Registered",
    "Registration Documents",
    "Function",
)

GP = Contract(
    "gp_raw",
    "1.0.0",
    (
        Field("OBJECT_NAME", TEXT, False),
        Field("OBJECT_ID", TEXT, False, COSPAR),
        Field("EPOCH", TEXT, False),
        Field("MEAN_MOTION", REAL, False, within(0.0, 20.0)),
        Field("ECCENTRICITY", REAL, False, below(0.0, 1.0)),
        Field("INCLINATION", REAL, False, within(0.0, 180.0)),
        Field("RA_OF_ASC_NODE", REAL, False, within(0.0, 360.0)),
        Field("ARG_OF_PERICENTER", REAL, False, within(0.0, 360.0)),
        Field("MEAN_ANOMALY", REAL, False, within(0.0, 360.0)),
        Field("EPHEMERIS_TYPE", INT, False, NOT_NEGATIVE),
        Field("CLASSIFICATION_TYPE", TEXT, False, (Rule("isin", CLASSIFICATIONS),)),
        Field("NORAD_CAT_ID", INT, False, POSITIVE),
        Field("ELEMENT_SET_NO", INT, False, NOT_NEGATIVE),
        Field("REV_AT_EPOCH", INT, False, NOT_NEGATIVE),
        Field("BSTAR", REAL, False),
        Field("MEAN_MOTION_DOT", REAL, False),
        Field("MEAN_MOTION_DDOT", REAL, False),
    ),
    key=("NORAD_CAT_ID",),
)

SATCAT = Contract(
    "satcat_raw",
    "1.0.0",
    (
        Field("OBJECT_NAME", TEXT, False),
        Field("OBJECT_ID", TEXT, False, COSPAR),
        Field("NORAD_CAT_ID", INT, False, POSITIVE),
        Field("OBJECT_TYPE", TEXT, False, (Rule("isin", OBJECT_TYPES),)),
        Field("OPS_STATUS_CODE", TEXT, True, (Rule("isin", OPERATION_CODES),)),
        Field("OWNER", TEXT, False),
        Field("LAUNCH_DATE", DATE, False, SPACE_AGE),
        Field("LAUNCH_SITE", TEXT, False),
        Field("DECAY_DATE", DATE, True, SPACE_AGE),
        Field("PERIOD", REAL, True, (Rule("ge", 0.0),)),
        Field("INCLINATION", REAL, True, within(0.0, 180.0)),
        Field("APOGEE", INT, True, NOT_NEGATIVE),
        Field("PERIGEE", INT, True, NOT_NEGATIVE),
        Field("RCS", REAL, True, (Rule("ge", 0.0),)),
        Field("DATA_STATUS_CODE", TEXT, True, (Rule("isin", DATA_CODES),)),
        Field("ORBIT_CENTER", TEXT, False),
        Field("ORBIT_TYPE", TEXT, False, (Rule("isin", ORBIT_TYPES),)),
    ),
    key=("NORAD_CAT_ID",),
)

CANONICAL = Contract(
    "canonical",
    "1.0.0",
    (
        Field("cospar_id", TEXT, False, COSPAR),
        Field("norad_cat_id", INT),
        Field("name_unoosa", TEXT),
        Field("object_name_celestrak", TEXT),
        Field("state_unoosa", TEXT),
        Field("country_celestrak", TEXT),
        Field("launch_date_unoosa", DATE, True, SPACE_AGE),
        Field("launch_date_celestrak", DATE, True, SPACE_AGE),
        Field("status", TEXT),
        Field("date_of_decay", DATE, True, SPACE_AGE),
        Field("un_registered", FLAG),
        Field("registration_documents", TEXT),
        Field("function", TEXT),
        Field("mean_motion", REAL, True, within(0.0, 20.0)),
        Field("eccentricity", REAL, True, below(0.0, 1.0)),
        Field("orbit_regime_canonical", TEXT, True, (Rule("isin", REGIMES),)),
        Field("orbit_regime_confidence", REAL, True, within(0.0, 1.0)),
        Field("match_source", TEXT, False, (Rule("isin", MATCH_SOURCES),)),
        Field("match_score", REAL, True, within(0.0, 1.0)),
        Field("match_confidence", TEXT, False, (Rule("isin", CONFIDENCES),)),
        Field("source_presence", TEXT, False, (Rule("isin", PRESENCES),)),
        Field("function_canonical", TEXT),
        Field("function_canonical_confidence", REAL, True, within(0.0, 1.0)),
        Field("snapshot_date", DATE, False, SPACE_AGE),
    ),
    key=("cospar_id",),
)
