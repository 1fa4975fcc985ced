"""JSON held as text: canonical form, reward maps, flattening to dotted paths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rewardmill.sources.scratch import checkpointed

EMPTY = "{}"


def canonical(text: Column) -> Column:
    """Keys sorted at every level; null where it isn't JSON (numbers print shortest: 1.0 as 1)."""
    return F.to_json(F.try_parse_json(text))


def wrapped(text: Column) -> Column:
    """Primitives as {"$value": x}, null as {}, objects and arrays as they are."""
    kind = F.schema_of_variant(F.try_parse_json(text))
    composite = kind.startswith("OBJECT") | kind.startswith("ARRAY")
    return (
        F.when(text.isNull() | (kind == "VOID"), EMPTY)
        .when(composite, canonical(text))
        .otherwise(F.concat(F.lit('{"$value":'), canonical(text), F.lit("}")))
    )


def rewards_map(text: Column) -> Column:
    """Message ids to their numbers' own text (100 stays 100, 1.0 stays 1.0)."""
    some = text.isNotNull() & (text != EMPTY)
    return F.when(some, F.from_json(text, "map<string,string>"))


def number(text: Column) -> Column:
    """A JSON number's text as a double; true is 1 and false 0, as they count as numbers."""
    return F.when(text == "true", 1.0).when(text == "false", 0.0).otherwise(text.try_cast("double"))


def rewards_text(entries: Column) -> Column:
    """Array of (message_id, value) structs as a JSON object with sorted keys."""
    each = F.transform(
        F.array_sort(entries),
        lambda e: F.concat(F.to_json(F.array(e["message_id"])), F.lit(":"), e["value"]),
    )
    # to_json of a one-element array quotes and escapes the key; its brackets go
    inner = F.transform(each, lambda x: F.regexp_replace(x, r'^\[(".*")\]:', "$1:"))
    return F.concat(F.lit("{"), F.array_join(inner, ","), F.lit("}"))


def rewards_total(entries: Column) -> Column:
    return F.aggregate(entries, F.lit(0.0), lambda s, e: s + F.coalesce(number(e["value"]), F.lit(0.0)))


def flatten(df: DataFrame, sources: dict[str, str], keys: list[str], max_depth: int = 4) -> DataFrame:
    """Long table (keys..., feature, num, str) of JSON text columns.

    ``sources`` maps a column to the prefix of its features. Objects and arrays become
    dotted paths; nulls and empty containers vanish; booleans are numbers; a scalar at
    the root has the bare prefix. Of a path met twice (a key that holds dots), the last
    in key order stays. Every level is one lateral explode; rows that are done leave. After
    each ``max_depth`` levels it is looked whether rows are still open; they are checkpointed
    and go on, so every leaf is found however deep it is.
    """
    parts = [
        df.select(*keys, F.lit(prefix).alias("feature"), F.try_parse_json(F.col(c)).alias("v"))
        for c, prefix in sources.items()
    ]
    open_rows = parts[0]
    for p in parts[1:]:
        open_rows = open_rows.unionByName(p)
    done, depth = None, 0
    while True:
        kind = F.schema_of_variant("v")
        nested = kind.startswith("OBJECT") | kind.startswith("ARRAY")
        text = F.try_variant_get("v", "$", "string")
        number_ = F.when(kind == "BOOLEAN", F.try_variant_get("v", "$", "boolean").cast("double")).when(
            kind != "STRING", F.try_variant_get("v", "$", "double")
        )
        leaves = open_rows.filter(F.col("v").isNotNull() & ~F.is_variant_null("v") & ~nested).select(
            *keys, "feature", number_.alias("num"), F.when(kind == "STRING", text).alias("str"), F.lit(depth).alias("_depth")
        )
        done = leaves if done is None else done.unionByName(leaves)
        nested_rows = open_rows.filter(nested)
        if depth % max(1, max_depth) == 0 and depth >= max_depth:
            if nested_rows.isEmpty():
                break
            nested_rows = checkpointed(nested_rows)
        depth += 1
        name = "_f"
        exploded = nested_rows.withColumnRenamed("feature", name).lateralJoin(
            _explode_variant(open_rows.sparkSession)
        )
        open_rows = exploded.select(
            *keys, F.concat(F.col(name), F.lit("."), F.coalesce(F.col("key"), F.col("pos").cast("string"))).alias("feature"), F.col("value").alias("v")
        )
    return done.groupBy(*keys, "feature").agg(
        F.max_by("num", "_depth").alias("num"), F.max_by("str", "_depth").alias("str")
    )


def _explode_variant(spark):
    return spark.tvf.variant_explode_outer(F.col("v").outer())
