"""Fixed values of the data contract, and nothing else.

Everything below has to be exactly as it is for results to agree with the tables and files
other tools in this field read and write: column names, header keys, slice names, id
patterns, the type order, file-name rules. No logic lives here.
"""

# ---- record table ---------------------------------------------------------------------
RECORD_COLUMNS = [
    "source_file",
    "TARGET",
    "NAME",
    "FEED",
    "TIMESTAMP",
    "col1",
    "col2",
    "col3",
    "col4",
    "col5",
]
HEADER_KEYS = ["TARGET", "NAME", "FEED", "TIMESTAMP"]
RECORD_FIELDS = 5
MAX_FIELDS = 9
FIELD_SEPARATOR = "|"
HEADER_MARK = "#"
SKIPPED_SUFFIXES = (".json",)

# ---- whitespace: every character that str.isspace() accepts -----------------------------
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# Line boundaries besides \n, \r and \r\n (those are already gone when lines are read).
EXTRA_LINE_BREAKS = "\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029"

# ---- metadata and resolution --------------------------------------------------------------
METADATA_COLUMNS = ["beacon_uri", "beacon_harvest_timestamp"]
RESOLVED_COLUMNS = ["target_uri", "target_id", "authority_id"]
ENRICHED_COLUMNS = ["gnd_type", "gnd_type_list"]
ID_PLACEHOLDER = "{ID}"

SLICES = [
    "target-null_col1-only",
    "target-null_col1-2",
    "target-null_col1-2-3",
    "target-notnull_col1-only",
    "target-notnull_col1-2",
    "target-notnull_col1-2-3",
]
# The order in which slices are listed in match reports and appended on a merge.
RESOLVABLE_SLICES = [
    "target-null_col1-2",
    "target-null_col1-2-3",
    "target-notnull_col1-only",
    "target-notnull_col1-2",
    "target-notnull_col1-2-3",
]

# ---- authority ids and types ----------------------------------------------------------------
AUTHORITY_URI_PREFIX = r"^https?://d-nb\.info/gnd/"
AUTHORITY_ISIL_PREFIX = r"^\([a-zA-Z]{2}-[0-9]{3}[a-zA-Z]?\)"
TYPE_PRIORITY = [
    "Person",
    "CorporateBody",
    "Work",
    "SubjectHeading",
    "PlaceOrGeographicName",
    "Family",
]
OTHER_TYPE = "Other"

# ---- file names -------------------------------------------------------------------------------
SAFE_PREFIX_LENGTH = 80
INDEX_FORMAT = "%04d_"
DEFAULT_FILE_NAME = "beacon.txt"
DEFAULT_EXTENSION = ".txt"
SAMPLES_SUFFIX = "_samples.json"

# ---- defaults of the inspection and sampling reports -------------------------------------------
PREVIEW_ROWS = 10
SAMPLE_ROWS = 100
SAMPLE_SEED = 42
STATS_ROWS = 200_000
EXAMPLE_ROWS = 20
DUPLICATE_EXAMPLES = 10
