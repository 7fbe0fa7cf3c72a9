"""From feed payloads to raw records: key, filter, count."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changefeed import schemas

UNKNOWN = "unknown"
BLOCK_BITS = 16


FIELD = "v STRUCT<wiki: STRING>"
ITEM = "ARRAY<STRUCT<wiki: STRING, meta: STRING>>"


def _is_object(payload: Column, items: Column) -> Column:
    """Whether the text is one JSON object and nothing else.

    The parser stops after the first value, so trailing text is found by parsing the payload
    as an array item; only a payload that could close that array itself is parsed again.
    """
    as_field = F.from_json(F.concat(F.lit('{"v":'), payload, F.lit("}")), FIELD, schemas.JSON_LIMITS)
    closed_inside = F.when(payload.contains("]"), as_field["v"].isNotNull()).otherwise(F.lit(True))
    one_item = (F.size(items) == 1) & F.get(items, F.lit(0)).isNotNull()
    return F.coalesce(F.ltrim(payload).startswith("{") & one_item & closed_inside, F.lit(False))


def with_route(events: DataFrame, wikis: Collection[str] = ()) -> DataFrame:
    """Add `key` and `accepted` to rows holding a payload in `data`.

    The key is the wiki, else the domain, else "unknown"; empty text counts as absent. With
    a list of wikis, an event without wiki and domain is not accepted. Repeated names (the last
    counts), NaN and values of any length are read like any other.
    """
    payload = F.col("data")
    # Exploding keeps the parsed value from being worked out anew for each use of it.
    items = F.from_json(F.concat(F.lit("["), payload, F.lit("]")), ITEM, schemas.JSON_LIMITS)
    parsed = events.select("*", F.explode(F.array(items)).alias("_items"))
    first = F.get(F.col("_items"), F.lit(0))
    domain = F.from_json(first["meta"], "domain STRING", schemas.JSON_LIMITS)["domain"]
    source = F.coalesce(F.nullif(first["wiki"], F.lit("")), F.nullif(domain, F.lit("")))
    accepted = F.col("_valid")
    if wikis:
        accepted = accepted & F.coalesce(F.col("_source").isin(*sorted(wikis)), F.lit(False))
    return (
        parsed.withColumn("_valid", _is_object(payload, F.col("_items")))
        .withColumn("_source", source)
        .withColumn("accepted", accepted)
        .withColumn("key", F.coalesce("_source", F.lit(UNKNOWN)))
        .drop("_items", "_valid", "_source")
    )


def route_raw(events: DataFrame, wikis: Collection[str] = ()) -> DataFrame:
    """Raw records: the payload untouched, keyed; malformed and unlisted events left out."""
    rest = [name for name in events.columns if name != "data"]
    return with_route(events, wikis).where("accepted").select("key", F.col("data").alias("value"), *rest)


def first_events(events: DataFrame, n: int, order: str = "offset") -> DataFrame:
    """Stop after `n` received events, before any is filtered.

    Offsets are cut into blocks and counted; blocks that lie wholly within the first `n` are
    taken as they are, and only the one in which the limit falls is put in order. `order` must
    tell the events apart.
    """
    block = F.shiftright(F.col(order).cast("bigint"), BLOCK_BITS)
    earlier = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = events.groupBy(block.alias("_block")).agg(F.count("*").alias("_size"))
    blocks = blocks.select("_block", "_size", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"))
    placed = events.withColumn("_block", block).join(blocks.where(F.col("_before") < n), "_block")
    whole = F.col("_before") + F.col("_size") <= n
    rank = F.row_number().over(Window.partitionBy("_block").orderBy(order))
    part = placed.where(~whole).withColumn("_rank", rank).where(F.col("_before") + F.col("_rank") <= n)
    return placed.where(whole).select(*events.columns).unionByName(part.select(*events.columns))


def counters() -> list[Column]:
    """Totals over routed events; `bytes_in` counts characters, as the feed's own counter does."""
    return [
        F.count("*").alias("received"),
        F.count_if("accepted").alias("produced"),
        F.count_if(~F.col("accepted")).alias("skipped"),
        F.coalesce(F.sum(F.length("data")), F.lit(0)).alias("bytes_in"),
    ]


def ingest_metrics(events: DataFrame, wikis: Collection[str] = ()) -> DataFrame:
    """One row of totals: received, produced, skipped, and characters received."""
    return with_route(events, wikis).agg(*counters())
