"""Declared schemas. Nothing is inferred; unknown JSON fields are ignored."""

# How long a JSON string and number may be, and how deep it may nest, before the parser gives up on the whole record.
JSON_LIMITS = {"maxStringLen": str(2**31 - 1), "maxNumLen": str(2**31 - 1), "maxNestingDepth": str(1_000_000)}

# The field names and types of the feed and of each output.
RAW_EDIT = """
    meta STRUCT<domain: STRING, dt: STRING, id: STRING, stream: STRING, uri: STRING>,
    id BIGINT,
    type STRING,
    namespace INT,
    title STRING,
    comment STRING,
    timestamp BIGINT,
    user STRING,
    bot BOOLEAN,
    minor BOOLEAN,
    patrolled BOOLEAN,
    length STRUCT<old: INT, new: INT>,
    revision STRUCT<old: BIGINT, new: BIGINT>,
    server_name STRING,
    wiki STRING
"""

# The raw fields that validation and the clean edits need.
RAW_NEEDED = """
    meta STRUCT<domain: STRING>,
    type STRING,
    namespace INT,
    title STRING,
    comment STRING,
    timestamp BIGINT,
    user STRING,
    bot BOOLEAN,
    minor BOOLEAN,
    length STRUCT<old: INT, new: INT>,
    revision STRUCT<new: BIGINT>,
    server_name STRING,
    wiki STRING
"""

CLEAN_EDIT = """
    wiki STRING,
    server_name STRING,
    domain STRING,
    type STRING,
    namespace INT,
    title STRING,
    user STRING,
    is_bot BOOLEAN,
    is_minor BOOLEAN,
    byte_delta INT,
    new_length INT,
    comment STRING,
    revision_id BIGINT,
    event_time TIMESTAMP
"""

REJECTED_EDIT = """
    reject_reason STRING,
    wiki STRING,
    title STRING,
    user STRING,
    type STRING,
    raw_timestamp BIGINT,
    rejected_at TIMESTAMP
"""

WIKI_STATS = """
    window_start TIMESTAMP,
    window_end TIMESTAMP,
    wiki STRING,
    edits BIGINT,
    bot_edits BIGINT,
    human_edits BIGINT,
    editors BIGINT,
    pages_touched BIGINT,
    new_pages BIGINT,
    bytes_added BIGINT,
    bytes_removed BIGINT,
    net_bytes BIGINT,
    bot_share_pct DOUBLE
"""

EDIT_WAR = """
    wiki STRING,
    title STRING,
    reverter STRING,
    opponent STRING,
    started_at TIMESTAMP,
    ended_at TIMESTAMP,
    seconds_elapsed BIGINT,
    swing_bytes INT
"""


def fields(ddl: str) -> list[tuple[str, str]]:
    """(name, type) pairs of a declaration, one field per line as written above."""
    lines = (line.strip().rstrip(",") for line in ddl.strip().splitlines())
    return [tuple(line.split(" ", 1)) for line in lines if line]


def names(ddl: str) -> list[str]:
    return [name for name, _ in fields(ddl)]


def without(ddl: str, *dropped: str) -> str:
    return ",\n".join(f"{name} {kind}" for name, kind in fields(ddl) if name not in dropped)
