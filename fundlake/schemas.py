"""Stage schemas, controlled vocabularies and other fixed values.

Everything here is a plain constant; the operators turn the vocabularies into
literal Spark arrays / CASE chains, so nothing is broadcast or collected.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# FIXED VALUES — these must equal the source pipeline's for identical results.
# Written in their original order; order matters for round-name matching.
# ---------------------------------------------------------------------------

# Funding round vocabulary (comma separated, items trimmed), in match order.
FUNDING_ROUNDS_TEXT = (
    "Pre-Seed, Seed, Series A, Series B, Series C, Series D, Series E, Series F, Other"
)
# Climate sector vocabulary.
CLIMATE_SECTORS_TEXT = (
    "Energy,Transportation,Agriculture,Forestry,Water and Oceans,Built Environment,"
    "Waste Management,Land Use and Ecosystem Services,Carbon Markets and Climate Finance,"
    "Climate Adaptation and Resilience,Circular Economy,Environmental Technology,"
    "Carbon Removal,Climate Advocacy and Policy"
)
# Company location vocabulary.
LOCATIONS_TEXT = "North America, South America, Europe, Russia, Asia, Middle East, Other"
# Company living status vocabulary.
LIVING_STATUSES = ("dead", "living", "unknown")
# Name given to a round that matches nothing in the vocabulary.
UNKNOWN_ROUND = "Unknown"
# Full English month names, January first (used by the textual date branch).
MONTH_NAMES = (
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
)
# Text a CSV reader treats as a missing value (pandas default NA tokens).
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)
# Columns leaked into stage outputs when a model echoes the schema wrapper.
SCHEMA_ECHO_COLUMNS = ("json_schema", "type")
# Marker of a retryable extraction failure.
RATE_LIMIT_MARKER = "rate_limit_exceeded"
# Marker the agent-loop model uses before its final JSON answer.
FINAL_ANSWER_MARKER = 'Final Answer":'
# Run timestamp format (UTC, no zone suffix).
RUN_TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"


def split_vocab(text: str) -> tuple[str, ...]:
    """Split a comma separated vocabulary and strip each item."""
    return tuple(item.strip() for item in text.split(","))


FUNDING_ROUNDS = split_vocab(FUNDING_ROUNDS_TEXT)
CLIMATE_SECTORS = split_vocab(CLIMATE_SECTORS_TEXT)
LOCATIONS = split_vocab(LOCATIONS_TEXT)

# ---------------------------------------------------------------------------
# Record layouts
# ---------------------------------------------------------------------------

# Company record fields and their declared JSON types ("null" = nullable).
COMPANY_FIELDS: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("company_name", ("string",)),
    ("founders", ("string", "null")),
    ("is_climate_related", ("boolean",)),
    ("climate_sectors", ("string", "null")),
    ("location", ("string", "null")),
    ("living_status", ("string",)),
    ("has_pivoted", ("boolean", "null")),
    ("year_founded", ("string", "null")),
    ("year_died", ("string", "null")),
    ("idea_summary", ("string", "null")),
    ("reason_for_demise", ("string", "null")),
)
COMPANY_REQUIRED = tuple(name for name, _ in COMPANY_FIELDS)

# Funding element fields and declared JSON types; currency is optional.
FUNDING_FIELDS: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("currency_symbol", ("string", "null")),
    ("round_name", ("string", "null")),
    ("amount", ("number", "null")),
    ("date", ("string", "null")),
)
FUNDING_REQUIRED = ("round_name", "amount", "date")
FUNDING_ENVELOPE_REQUIRED = ("funding_rounds",)

PAGE_SCHEMA = T.StructType([
    T.StructField("url", T.StringType()),
    T.StructField("status", T.IntegerType()),
    T.StructField("html", T.StringType()),
])

LISTING_SCHEMA = T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("author", T.StringType()),
    T.StructField("publication_date", T.StringType()),
    T.StructField("timestamp", T.StringType()),
])

ARTICLE_SCHEMA = T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("author", T.StringType()),
    T.StructField("publication_date", T.StringType()),
    T.StructField("content", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("url", T.StringType()),
])

COMPANY_SCHEMA = T.StructType(
    [
        T.StructField(
            name,
            T.BooleanType() if "boolean" in types else T.StringType(),
            "null" in types,
        )
        for name, types in COMPANY_FIELDS
    ]
    + [
        T.StructField("url", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("uuid", T.StringType()),
    ]
)

ENRICHED_COMPANY_SCHEMA = T.StructType(
    COMPANY_SCHEMA.fields + [T.StructField("funding_rounds", T.StringType())]
)

RECONCILED_ROUND_TYPE = T.StructType([
    T.StructField("currency_symbol", T.StringType()),
    T.StructField("date", T.StringType()),
    T.StructField("amount", T.LongType()),
    T.StructField("round_name", T.StringType()),
])

RESPONSE_SCHEMA = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("raw", T.StringType()),
    T.StructField("error", T.StringType()),
    T.StructField(
        "steps",
        T.ArrayType(T.StructType([
            T.StructField(
                "message_log",
                T.ArrayType(T.StructType([T.StructField("total_tokens", T.LongType())])),
            )
        ])),
    ),
])

ORGANIZATION_FIELDS = (
    "created_at", "entity_def_id", "facebook", "facet_ids", "identifier", "image_id",
    "image_url", "linkedin", "location_identifiers", "name", "permalink",
    "short_description", "stock_exchange_symbol", "twitter", "updated_at", "uuid",
    "website_url",
)

ORGANIZATION_SCHEMA = T.StructType([
    T.StructField(
        name,
        T.ArrayType(T.StringType())
        if name in ("facet_ids", "location_identifiers")
        else T.StringType(),
    )
    for name in ORGANIZATION_FIELDS
])


# ---------------------------------------------------------------------------
# Declared replies (for functions.schema_rules)
# ---------------------------------------------------------------------------

_COMPANY_WORDS = {
    "climate_sectors": {"list_vocabulary": CLIMATE_SECTORS, "only_if": ("is_climate_related", True)},
    "location": {"vocabulary": LOCATIONS},
    "living_status": {"vocabulary": LIVING_STATUSES},
}
#: The company reply: its fields, all required, no others; sectors only of climate companies.
COMPANY_DECLARATION = {
    "type": "object",
    "properties": {name: {"type": types, **_COMPANY_WORDS.get(name, {})} for name, types in COMPANY_FIELDS},
    "required": COMPANY_REQUIRED,
    "additionalProperties": False,
}
#: The funding reply: a list of rounds.
FUNDING_DECLARATION = {
    "type": "object",
    "properties": {
        "funding_rounds": {
            "type": "array",
            "items": {
                "type": "object",
                "properties": {
                    name: {"type": types, **({"vocabulary": FUNDING_ROUNDS} if name == "round_name" else {})}
                    for name, types in FUNDING_FIELDS
                },
                "required": FUNDING_REQUIRED,
                "additionalProperties": False,
            },
        }
    },
    "required": FUNDING_ENVELOPE_REQUIRED,
    "additionalProperties": False,
}
