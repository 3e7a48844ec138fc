"""Record routing (B1-B9): the feed client's per-message logic as one Spark job over a raw
JSON ``value`` column, batch or stream. Map-only: no shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake import schemas as S
from marketlake.functions import instant_to_utc_ntz

DEFAULT_TOPICS = {S.CHANNEL_TICKER: S.TOPIC_TICKER, S.CHANNEL_TRADES: S.TOPIC_TRADES}


def utc_now_iso() -> Column:
    """Current instant as ISO-8601 UTC text with microseconds and ``+00:00``."""
    return F.date_format(instant_to_utc_ntz(F.current_timestamp()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


def first_product_id(msg: str = "m") -> Column:
    """Product id of the first event only. A non-empty ticker list decides (even when
    its first item has no product id); otherwise a non-empty trade list; otherwise NULL."""
    e0 = F.get(F.col(f"{msg}.events"), 0)
    tickers, trades = e0.getField("tickers"), e0.getField("trades")
    return (F.when(F.size(tickers) > 0, F.get(tickers, 0).getField("product_id"))
            .when(F.size(trades) > 0, F.get(trades, 0).getField("product_id")))


def _quoted(text: Column) -> Column:
    """A string as JSON."""
    listed = F.to_json(F.array(text))
    return F.substr(listed, F.lit(2), F.length(listed) - 2)


def stamped(text: Column, stamps: Mapping[str, Column]) -> Column:
    """The JSON object ``text`` with the fields ``stamps``. The text itself is sent, numbers of any length
    and form, nulls and unknown fields as they came. Only an object that holds a field twice, or one of the
    stamps already, is put together again: of equal fields the last one counts, old stamps go."""
    added = F.concat_ws(",", *(F.concat(F.lit(f'"{name}":'), _quoted(value)) for name, value in stamps.items()))
    names = F.json_object_keys(text)
    clash = (F.size(F.array_distinct(names)) < F.size(names)) | F.arrays_overlap(names, F.array(*map(F.lit, stamps)))
    # values as text; the variants only tell strings from the rest. Where they fail (a field twice further
    # down), what reads as a number, truth value, list or object is none
    parsed = F.struct(F.map_entries(F.from_json(text, "map<string, string>")).alias("texts"), F.map_entries(F.from_json(text, "map<string, variant>")).alias("kinds"))

    def again(p: Column) -> Column:
        def field(entry: Column, i: Column) -> Column:
            kind = F.schema_of_variant(F.get(p["kinds"], i)["value"])
            bare = F.coalesce(kind != "STRING", entry["value"].rlike(r"(?s)^(-?\d+(\.\d+)?([eE][+-]?\d+)?|true|false|\[.*\]|\{.*\})$"))
            shown = F.when(entry["value"].isNull(), F.lit("null")).when(bare, entry["value"]).otherwise(_quoted(entry["value"]))
            goes = entry["key"].isin(*stamps) | F.exists(F.slice(p["texts"], i + 2, F.size(p["texts"])), lambda later: later["key"] == entry["key"])
            return F.when(~goes, F.concat(_quoted(entry["key"]), F.lit(":"), shown))

        return F.concat(F.lit("{"), F.concat_ws(",", F.array_compact(F.transform(p["texts"], field)), added), F.lit("}"))

    # as a lambda's variable, the object is parsed once
    rebuilt = F.transform(F.array(parsed), again)[0]
    return F.when(clash, rebuilt).otherwise(F.concat(F.regexp_replace(text, r"\}\s*$", ""), F.lit(","), added, F.lit("}")))


def classified(raw: DataFrame, value_col: str = "value", topics: Mapping[str, str] = DEFAULT_TOPICS, products: Sequence[str] | None = None) -> DataFrame:
    """(text, channel, product_id, reason): every message, read by its declared layout, and why it is not
    routed: ``not_json`` (no JSON object), ``no_channel``, ``other_channel``, ``no_product`` or
    ``not_subscribed``; NULL for those that are. Null messages are ``not_json``."""
    text = F.col(value_col).cast("string")
    parsed = raw.select(F.from_json(text, S.ANY_MESSAGE).alias("m"), text.alias("text")).withColumn("product_id", first_product_id("m"))
    channel = F.col("m.channel")
    reason = (F.when(channel.isNull(), F.when(F.json_object_keys("text").isNull(), "not_json").otherwise("no_channel"))
              .when(~channel.isin(*topics.keys()), "other_channel")
              .when(F.coalesce(F.length("product_id"), F.lit(0)) == 0, "no_product"))
    if products is not None:
        reason = reason.when(~F.col("product_id").isin(*products), "not_subscribed")
    return parsed.select("text", channel.alias("channel"), "product_id", reason.alias("reason"))


def routed(messages: DataFrame, ingest_ts: Column | str | None = None, source: str = S.SOURCE_TAG, topics: Mapping[str, str] = DEFAULT_TOPICS) -> DataFrame:
    """The messages of :func:`classified` without a reason, for a keyed sink."""
    stamp = utc_now_iso() if ingest_ts is None else (F.lit(ingest_ts) if isinstance(ingest_ts, str) else ingest_ts)
    topic = None
    for channel, name in topics.items():
        topic = (F.when if topic is None else topic.when)(F.col("channel") == channel, F.lit(name))
    value = stamped(F.col("text"), {"ingest_ts": stamp, "source": F.lit(source)})
    kept = messages.filter(F.col("reason").isNull())
    return kept.select(
        topic.alias("topic"),
        F.col("product_id").alias("key"),
        value.alias("value"),
        "channel",
        "product_id",
    )


def dead_letters(messages: DataFrame) -> DataFrame:
    """(value, reason): the messages of :func:`classified` that are not routed, as they came."""
    return messages.filter(F.col("reason").isNotNull()).select(F.col("text").alias("value"), "reason")


def route_messages(
    raw: DataFrame,
    value_col: str = "value",
    ingest_ts: Column | str | None = None,
    source: str = S.SOURCE_TAG,
    topics: Mapping[str, str] = DEFAULT_TOPICS,
    products: Sequence[str] | None = None,
) -> DataFrame:
    """Raw messages -> ``(topic, key, value, channel, product_id)`` ready for a keyed sink.

    Drops text that is not a JSON object with a channel (B1), channels other than ticker and
    market_trades (B2), messages without a non-empty product id (B4); stamps ``ingest_ts``
    (B5, one value per micro-batch; pass a literal for reproducible runs) and ``source``
    (B6); picks the topic by channel (B7) and sends the whole document with these two fields
    (B8), unknown fields and explicit nulls included. ``products`` restricts to a
    subscription set (B9).
    """
    return routed(classified(raw, value_col, topics, products), ingest_ts, source, topics)
