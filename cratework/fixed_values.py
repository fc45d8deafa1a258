"""Layouts, limits and message texts that results must match exactly."""

# Key layouts of the layers.
LANDING_KEY = "{source_name}/{dataset_name}/ingest_date={date}/{file_name}"
BRONZE_KEY = "{source_name}/{dataset_name}/ingest_date={date}/zip_name={zip_stem}"
SCHEMA_STATUS_KEY = "{bronze_key}/schema_status={schema_status}"
SUCCESS_MARKER = "_SUCCESS"

# Schema contract outcomes, also the names of the routing directories.
VALID = "valid"
INVALID = "invalid"

# Limits.
MAX_ROWS_PER_FILE = 5_000_000
COPY_CHUNK_BYTES = 16 * 1024 * 1024
ARRIVAL_TIMEOUT_HOURS = 24

# Lineage columns, in the order in which they follow the data columns.
LINEAGE_COLUMNS = (
    "_bronze_processed_at",
    "_dag_run_id",
    "_zip_file_name",
    "_source_file_name",
    "_schema_status",
)

# Registry validation messages.
MSG_NO_BASE_URL = "Source '{source}' must have a 'base_url'."
MSG_BAD_SCHEME = (
    "Source '{source}' has base_url '{base_url}'; "
    "expected one of {schemes} as the scheme."
)
MSG_NOTHING_AFTER_SCHEME = (
    "Source '{source}' has nothing after the scheme in base_url '{base_url}'."
)
MSG_NO_ENDPOINTS = (
    "At least one endpoint is required: the {source} source has no endpoints."
)
MSG_BAD_ENDPOINT = (
    "Source '{source}' has an endpoint that is missing "
    "'path' or 'dataset_name': {endpoint}"
)
MSG_BAD_TEMPLATE = (
    "Endpoint '{path}' or dataset name '{dataset_name}' in source "
    "'{source}' is invalid or references an undefined parameter: {cause}"
)
# Python's own texts for template errors.
CAUSE_POSITIONAL = "Replacement index {index} out of range for positional args tuple"
CAUSE_OPEN_BRACE = "expected '}' before end of string"
CAUSE_INNER_BRACE = "unexpected '{' in field name"
CAUSE_LAST_BRACE = "Single '{' encountered in format string"
CAUSE_CLOSE_BRACE = "Single '}' encountered in format string"

# Report texts.
ERRORS_HEAD = "Malformed sources:<ul>"
ERRORS_ITEM = "<li><b>{source}</b>: {messages}</li>"
ERRORS_TAIL = "</ul>"
INVALID_FILES = "Files with invalid schema: {names}<br>Location: {location}"
INVALID_FILES_SUBJECT = "[Airflow Warning] Files with invalid schema in ZIP: {landing_key}"

# Landing size check messages.
MSG_UNVERIFIABLE = "{uri} could not be verified"
MSG_SIZE_MISMATCH = "Transfer size mismatch for {key}"
MSG_DELETED = " The file was deleted from {bucket}."
MSG_DELETE_FAILED = " Attempted deletion also failed; object left in place."
