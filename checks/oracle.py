"""DuckDB SQL for each query, written from the meaning of the query and not from its plan."""

from __future__ import annotations

RAW = """
raw AS (
  SELECT event_id AS "offset", event_id, user_id, value AS amount,
    event_id % 101 = 0 AS broken,
    CASE WHEN event_id % 97 <> 0 THEN event_type END AS wiki,
    CASE WHEN event_id % 89 <> 0 THEN 'page_' || (event_id % 20) END AS title,
    CASE WHEN event_id % 83 <> 0 THEN 'u' || (user_id % 4) END AS "user",
    CASE WHEN event_id % 79 <> 0 THEN CAST(floor(epoch(ts)) AS BIGINT) END AS seconds,
    CASE WHEN event_id % 44 = 4 THEN NULL
         WHEN event_id % 11 = 0 THEN 'new' WHEN event_id % 11 = 1 THEN 'categorize'
         WHEN event_id % 11 = 2 THEN 'log' WHEN event_id % 11 = 3 THEN 'bogus'
         ELSE 'edit' END AS type,
    CASE WHEN event_id % 13 <> 0 THEN user_id % 11 = 0 END AS bot,
    event_id % 5 = 0 AS minor,
    CASE WHEN event_id % 11 <> 0 THEN CAST(user_id * 10 AS INTEGER) END AS old_length,
    CAST(user_id * 10 + floor(value) - 20 AS INTEGER) AS new_length,
    props AS comment,
    event_type || '.example.org' AS site
  FROM events
)"""

PAYLOAD = """
payloads AS (
  SELECT "offset", wiki, site, broken,
    CASE WHEN broken THEN 'not json' ELSE CAST(to_json(struct_pack(
      meta := struct_pack(domain := site), id := event_id, type := type, namespace := 0, title := title,
      comment := comment, "timestamp" := seconds, "user" := "user", bot := bot, minor := minor,
      length := struct_pack(old := old_length, new := new_length), revision := struct_pack(new := event_id),
      server_name := site, wiki := wiki)) AS VARCHAR) END AS value
  FROM raw
)"""

PARSED = """
parsed AS (
  SELECT "offset",
    CASE WHEN NOT broken THEN wiki END AS wiki, CASE WHEN NOT broken THEN title END AS title,
    CASE WHEN NOT broken THEN "user" END AS "user", CASE WHEN NOT broken THEN seconds END AS seconds,
    CASE WHEN NOT broken THEN type END AS type, CASE WHEN NOT broken THEN bot END AS bot,
    CASE WHEN NOT broken THEN minor END AS minor, CASE WHEN NOT broken THEN old_length END AS old_length,
    CASE WHEN NOT broken THEN new_length END AS new_length, CASE WHEN NOT broken THEN comment END AS comment,
    CASE WHEN NOT broken THEN site END AS site, CASE WHEN NOT broken THEN event_id END AS event_id,
    CASE WHEN NOT broken THEN 0 END AS namespace
  FROM raw
)"""

def checked(lossless: bool = False) -> str:
    """Each parsed edit with the first rule it breaks; clean ones break none and have a type."""
    missing_type = "WHEN type IS NULL THEN 'missing_type'" if lossless else ""
    return f"""
checked AS (
  SELECT *, CASE
      WHEN wiki IS NULL THEN 'missing_wiki'
      WHEN title IS NULL THEN 'missing_title'
      WHEN "user" IS NULL THEN 'missing_user'
      WHEN seconds IS NULL THEN 'missing_timestamp'
      {missing_type}
      WHEN type NOT IN ('edit', 'new', 'categorize', 'log') THEN 'unknown_type'
    END AS reject_reason
  FROM parsed
)"""


CLEAN = """
clean AS (
  SELECT wiki, site AS server_name, site AS domain, type, namespace, title, "user",
    ifnull(bot, FALSE) AS is_bot, ifnull(minor, FALSE) AS is_minor,
    ifnull(new_length, 0) - ifnull(old_length, 0) AS byte_delta, new_length, comment,
    event_id AS revision_id, make_timestamp(seconds * 1000000) AS event_time, "offset"
  FROM checked WHERE reject_reason IS NULL AND type IS NOT NULL
)"""

DLQ = """
dlq AS (
  SELECT reject_reason, wiki, title, "user", type, seconds AS raw_timestamp, "offset"
  FROM checked WHERE reject_reason IS NOT NULL
)"""


def stats(minutes: int) -> str:
    width = 60 * minutes
    return f"""
stats AS (
  SELECT make_timestamp(bucket * {width} * 1000000) AS window_start,
    make_timestamp((bucket + 1) * {width} * 1000000) AS window_end, wiki, edits, bot_edits, human_edits, editors,
    pages_touched, new_pages, bytes_added, bytes_removed, bytes_added + bytes_removed AS net_bytes,
    CAST((20000 * bot_edits + edits) // (2 * edits) AS DOUBLE) / 100 AS bot_share_pct
  FROM (
    SELECT CAST(epoch(event_time) AS BIGINT) // {width} AS bucket, wiki, count(*) AS edits,
      CAST(count_if(is_bot) AS BIGINT) AS bot_edits, CAST(count_if(NOT is_bot) AS BIGINT) AS human_edits,
      len(list(DISTINCT "user")) AS editors, len(list(DISTINCT title)) AS pages_touched,
      CAST(count_if(type = 'new') AS BIGINT) AS new_pages,
      CAST(sum(greatest(byte_delta, 0)) AS BIGINT) AS bytes_added,
      CAST(sum(least(byte_delta, 0)) AS BIGINT) AS bytes_removed
    FROM clean GROUP BY ALL
  )
)"""


def wars(source: str, within_seconds: int) -> str:
    """Candidates by position in the page, then the greedy choice by recursion."""
    return f"""
placed AS (
  SELECT *, row_number() OVER page AS rn,
    lead("user", 1) OVER page AS user_1, lead(is_bot, 1) OVER page AS bot_1, lead(byte_delta, 1) OVER page AS delta_1,
    lead("user", 2) OVER page AS user_2, lead(byte_delta, 2) OVER page AS delta_2,
    lead(event_time, 2) OVER page AS time_2
  FROM {source} WINDOW page AS (PARTITION BY wiki, title ORDER BY event_time, "offset")
),
candidates AS (
  SELECT * FROM placed
  WHERE NOT is_bot AND user_1 <> "user" AND NOT bot_1 AND user_2 = "user"
    AND time_2 < event_time + INTERVAL {within_seconds} SECOND
),
chosen AS (
  SELECT wiki, title, min(rn) AS rn FROM candidates GROUP BY wiki, title
  UNION ALL
  SELECT chosen.wiki, chosen.title, (
    SELECT min(c.rn) FROM candidates c
    WHERE c.wiki = chosen.wiki AND c.title = chosen.title AND c.rn >= chosen.rn + 3) AS rn
  FROM chosen WHERE chosen.rn IS NOT NULL
),
wars AS (
  SELECT c.wiki, c.title, c."user" AS reverter, c.user_1 AS opponent, c.event_time AS started_at,
    c.time_2 AS ended_at, date_sub('second', c.event_time, c.time_2) AS seconds_elapsed,
    CAST(c.delta_1 + c.delta_2 AS INTEGER) AS swing_bytes
  FROM candidates c JOIN chosen USING (wiki, title, rn)
)"""


DENSE = """
dense AS (
  SELECT event_type AS wiki, 'page_' || (event_id % 20) AS title, 'u' || (user_id % 4) AS "user",
    user_id % 11 = 0 AS is_bot, CAST(floor(value) - 20 AS INTEGER) AS byte_delta,
    make_timestamp(((CAST(floor(epoch(ts)) AS BIGINT) - 1704067200) // 60 + 1704067200) * 1000000) AS event_time,
    event_id AS "offset"
  FROM events
)"""

KEYED = """
keyed AS (
  SELECT wiki AS key, CAST(to_json(struct_pack(server_name := server_name, domain := domain, type := type,
      namespace := namespace, title := title, "user" := "user", is_bot := is_bot, is_minor := is_minor,
      byte_delta := byte_delta, new_length := new_length, comment := comment, revision_id := revision_id,
      event_time := strftime(event_time, '%Y-%m-%d %H:%M:%SZ'))) AS VARCHAR) AS value, "offset"
  FROM clean
)"""

DEAD_LETTERS = """
dead_letters AS (
  SELECT CAST(to_json(struct_pack(reject_reason := reject_reason, wiki := wiki, title := title, "user" := "user",
    type := type, raw_timestamp := raw_timestamp)) AS VARCHAR) AS value, "offset"
  FROM dlq
)"""

UPSERT = """
upsert AS (
  SELECT CAST(to_json(struct_pack(window_start := strftime(window_start, '%Y-%m-%d %H:%M:%S'), wiki := wiki))
      AS VARCHAR) AS key,
    CAST(to_json(struct_pack(window_start := strftime(window_start, '%Y-%m-%d %H:%M:%S'),
      window_end := strftime(window_end, '%Y-%m-%d %H:%M:%S'), wiki := wiki, edits := edits, bot_edits := bot_edits,
      human_edits := human_edits, editors := editors, pages_touched := pages_touched, new_pages := new_pages,
      bytes_added := bytes_added, bytes_removed := bytes_removed, net_bytes := net_bytes,
      bot_share_pct := bot_share_pct)) AS VARCHAR) AS value
  FROM stats
)"""

ROUTED = """
routed AS (
  SELECT "offset", value, NOT broken AS is_json, CASE WHEN NOT broken THEN coalesce(wiki, site) END AS source
  FROM payloads
)"""

LATE = """
arrivals AS (
  SELECT wiki, title, "user", event_time, revision_id, revision_id % 3 AS partition,
    CASE WHEN "offset" % 7 = 0 THEN ("offset" + 40) * 2 + 1 ELSE "offset" * 2 END AS "offset"
  FROM clean
),
marked AS (
  SELECT *, max(event_time) OVER (PARTITION BY partition ORDER BY "offset"
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 15 SECOND AS watermark,
    date_trunc('minute', event_time) + INTERVAL 1 MINUTE AS window_end
  FROM arrivals
)"""

# What a reader of the capture must see of each payload, one row per block.
BLOCKS = """
blocks AS (
  SELECT "offset",
    CASE WHEN "offset" % 9 = 0 THEN 'edit' ELSE 'message' END AS event,
    concat_ws(chr(10), CASE WHEN "offset" % 8 = 0 THEN 'first' END, CASE WHEN "offset" % 17 <> 0 THEN value END) AS data,
    CASE WHEN "offset" % 4 <> 3 THEN CAST("offset" AS VARCHAR) END AS id,
    CASE WHEN "offset" % 12 = 0 AND "offset" % 24 <> 0 THEN CAST("offset" % 100 AS INTEGER) END AS retry_ms
  FROM payloads
)"""


def with_ctes(*ctes: str, select: str, recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' if recursive else ''}{','.join(ctes)}\n{select}"


PARSED_FEED = (RAW, PARSED)
SPLIT = (*PARSED_FEED, checked(), DLQ)
CLEANED = (*PARSED_FEED, checked(), CLEAN)
BOTH = (*CLEANED, DLQ)
CLEAN_COLUMNS = (
    'wiki, server_name, domain, type, namespace, title, "user", is_bot, is_minor, byte_delta, new_length,'
    " comment, revision_id, event_time"
)
REJECTED_COLUMNS = 'reject_reason, wiki, title, "user", type, raw_timestamp'
CLEAN_WARS = with_ctes(*CLEANED, wars("clean", 172800), select="SELECT * FROM wars", recursive=True)
DENSE_WARS = with_ctes(DENSE, wars("dense", 600), select="SELECT * FROM wars", recursive=True)


def stats_query(minutes: int) -> str:
    return with_ctes(*CLEANED, stats(minutes), select="SELECT * FROM stats")


def oracle_sql() -> dict[str, str]:
    return {
        "raw_scan": with_ctes(RAW, PAYLOAD, select='SELECT "offset", value FROM payloads'),
        "parse_raw": with_ctes(
            *PARSED_FEED,
            select="""SELECT "offset", site AS domain, event_id AS id, type, namespace, title, comment,
              seconds AS "timestamp", "user", bot, minor, CAST(NULL AS BOOLEAN) AS patrolled, old_length, new_length,
              event_id AS revision_id, site AS server_name, wiki, make_timestamp(seconds * 1000000) AS event_time
              FROM parsed""",
        ),
        "clean_edits": with_ctes(*CLEANED, select=f"SELECT {CLEAN_COLUMNS} FROM clean"),
        "dlq_edits": with_ctes(*SPLIT, select=f"SELECT {REJECTED_COLUMNS} FROM dlq"),
        "dlq_edits_lossless": with_ctes(
            *PARSED_FEED, checked(lossless=True), DLQ, select=f"SELECT {REJECTED_COLUMNS} FROM dlq"
        ),
        "dlq_reasons": with_ctes(
            *SPLIT, select="SELECT reject_reason, count(*) AS records FROM dlq GROUP BY reject_reason"
        ),
        "fan_out": with_ctes(
            *BOTH,
            select="""SELECT 'clean' AS outlet, "offset", CAST(NULL AS VARCHAR) AS reject_reason, wiki, title FROM clean
              UNION ALL SELECT 'dlq', "offset", reject_reason, wiki, title FROM dlq""",
        ),
        "stream_clean": with_ctes(
            *BOTH,
            select="""SELECT 'clean' AS outlet, "offset", CAST(NULL AS VARCHAR) AS reject_reason, wiki, title FROM clean
              UNION ALL SELECT 'dlq', "offset", reject_reason, wiki, title FROM dlq""",
        ),
        "wiki_stats": stats_query(1),
        "wiki_stats_5m": stats_query(5),
        "wiki_stats_1d": stats_query(1440),
        "wiki_stats_approx": stats_query(1440),
        "wiki_stats_widened": stats_query(1440),
        "replay_stats": stats_query(1),
        "stream_stats": stats_query(1),
        "stream_stats_upserts": stats_query(1440),
        "late_edits": with_ctes(
            *CLEANED,
            LATE,
            select="""SELECT partition, "offset", wiki, title, "user", revision_id, event_time, window_end, watermark
              FROM marked WHERE window_end <= watermark""",
        ),
        "edit_wars": CLEAN_WARS,
        "edit_wars_10m": DENSE_WARS,
        "edit_wars_sliced": DENSE_WARS,
        "replay_wars": CLEAN_WARS,
        "stream_wars": DENSE_WARS,
        "stream_late": with_ctes(
            *CLEANED,
            select="""SELECT CASE WHEN event_time IS NULL THEN 'untimed'
                WHEN "offset" > middle AND date_trunc('minute', event_time) + INTERVAL 1 MINUTE <= watermark THEN 'late'
                ELSE 'on_time' END AS outlet, "offset", wiki, event_time
              FROM clean, (
                SELECT middle, (SELECT max(event_time) FROM clean WHERE "offset" <= middle) - INTERVAL 15 SECOND AS watermark
                FROM (SELECT max("offset") / 2 AS middle FROM clean)
              )""",
        ),
        "stream_state": with_ctes(
            *CLEANED,
            select="""SELECT 'stats' AS job, operator, CASE operator WHEN 1 THEN (
                  SELECT count(*) FROM (
                    SELECT DISTINCT date_trunc('day', event_time), wiki, kind, CASE kind WHEN 'user' THEN "user" ELSE title END
                    FROM clean, (SELECT unnest(['user', 'title']) AS kind)
                    WHERE date_trunc('day', event_time) + INTERVAL 1 DAY > (SELECT max(event_time) FROM clean) - INTERVAL 15 SECOND
                  )
                ) ELSE 0 END AS rows, (SELECT max(event_time) FROM clean) - INTERVAL 15 SECOND AS watermark
              FROM (SELECT unnest([0::BIGINT, 1::BIGINT]) AS operator)""",
        ),
        "sequenced_records": with_ctes(
            *CLEANED,
            KEYED,
            select="""SELECT key, value, "offset", row_number() OVER (PARTITION BY key ORDER BY "offset") - 1 AS seq
              FROM keyed""",
        ),
        "sequence_gaps": with_ctes(
            *CLEANED,
            KEYED,
            select="""SELECT key, max(seq) + 1 - count(*) AS missing, count(*) FILTER ("offset" % 50 = 1) AS repeated,
                CAST(0 AS BIGINT) AS misplaced
              FROM (SELECT key, "offset", row_number() OVER (PARTITION BY key ORDER BY "offset") - 1 AS seq FROM keyed)
              WHERE "offset" % 100 <> 0 GROUP BY key
              HAVING max(seq) + 1 > count(*) OR count(*) FILTER ("offset" % 50 = 1) > 0""",
        ),
        "encode_keyed": with_ctes(*CLEANED, KEYED, select="SELECT key, value FROM keyed"),
        "decode_keyed": with_ctes(*CLEANED, select=f"SELECT {CLEAN_COLUMNS} FROM clean"),
        "encode_upsert": with_ctes(*CLEANED, stats(1), UPSERT, select="SELECT key, value FROM upsert"),
        "latest_upserts": with_ctes(*CLEANED, stats(1), UPSERT, select="SELECT key, value FROM upsert"),
        "encode_dlq": with_ctes(
            *SPLIT, DEAD_LETTERS, select="SELECT CAST(NULL AS VARCHAR) AS key, value FROM dead_letters"
        ),
        "fan_out_records": with_ctes(
            *BOTH,
            KEYED,
            DEAD_LETTERS,
            select="""SELECT 'wiki.edits.clean' AS topic, key, value, "offset" FROM keyed
              UNION ALL SELECT 'wiki.edits.dlq', NULL, value, "offset" FROM dead_letters""",
        ),
        "encode_alerts": with_ctes(
            DENSE,
            wars("dense", 600),
            select="""SELECT CAST(NULL AS VARCHAR) AS key, CAST(to_json(struct_pack(wiki := wiki, title := title,
              reverter := reverter, opponent := opponent,
              started_at := strftime(started_at, '%Y-%m-%d %H:%M:%SZ'),
              ended_at := strftime(ended_at, '%Y-%m-%d %H:%M:%SZ'), seconds_elapsed := seconds_elapsed,
              swing_bytes := swing_bytes)) AS VARCHAR) AS value FROM wars""",
            recursive=True,
        ),
        "latest_per_key": with_ctes(
            *CLEANED,
            KEYED,
            select="""SELECT key, value, "offset" FROM keyed
              QUALIFY row_number() OVER (PARTITION BY key ORDER BY "offset" DESC) = 1""",
        ),
        "topic_counts": with_ctes(
            *BOTH,
            stats(1),
            wars("clean", 172800),
            recursive=True,
            select="""SELECT 'wiki.edits.raw' AS topic, count(*) AS records FROM raw
              UNION ALL SELECT 'wiki.edits.clean', count(*) FROM clean
              UNION ALL SELECT 'wiki.edits.dlq', count(*) FROM dlq
              UNION ALL SELECT 'wiki.stats.per_wiki_1m', count(*) FROM stats
              UNION ALL SELECT 'wiki.alerts.edit_wars', count(*) FROM wars""",
        ),
        "tail": with_ctes(
            *CLEANED, KEYED, select='SELECT key, value, "offset" FROM keyed ORDER BY "offset" LIMIT 5'
        ),
        "sse_events": with_ctes(
            RAW, PAYLOAD, BLOCKS, select="SELECT event, data, id, retry_ms FROM blocks WHERE data <> ''"
        ),
        "resume_position": with_ctes(
            RAW,
            PAYLOAD,
            BLOCKS,
            select="""SELECT arg_max(id, "offset") AS last_event_id FROM blocks WHERE id IS NOT NULL""",
        ),
        "route_raw": with_ctes(
            RAW,
            PAYLOAD,
            ROUTED,
            select="""SELECT coalesce(source, 'unknown') AS key, value, "offset" FROM routed WHERE is_json""",
        ),
        "ingest_appends": with_ctes(
            RAW,
            PAYLOAD,
            ROUTED,
            select="""SELECT coalesce(source, 'unknown') AS key, value FROM routed
              WHERE is_json AND "offset" % 8 <> 0 AND "offset" % 17 <> 0""",
        ),
        "route_raw_filtered": with_ctes(
            RAW,
            PAYLOAD,
            ROUTED,
            select="""SELECT source AS key, value, "offset" FROM routed
              WHERE is_json AND source IN ('click', 'error.example.org')""",
        ),
        "route_raw_limited": with_ctes(
            RAW,
            PAYLOAD,
            ROUTED,
            select="""SELECT coalesce(source, 'unknown') AS key, value, "offset"
              FROM (SELECT * FROM routed ORDER BY "offset" LIMIT 1000) WHERE is_json""",
        ),
        "ingest_metrics": with_ctes(
            RAW,
            PAYLOAD,
            ROUTED,
            select="""SELECT count(*) AS received, count(*) FILTER (WHERE is_json) AS produced,
              count(*) FILTER (WHERE NOT is_json) AS skipped, CAST(sum(length(value)) AS BIGINT) AS bytes_in
              FROM routed""",
        ),
    }
