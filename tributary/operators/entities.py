"""Tags and places of drops, from captured answers of the entity service."""

from pyspark.sql import functions as F

#: Failed attempts allowed, and the name places are credited to.
MAX_RETRIES = 5
PLACE_SOURCE = "gisgraphy"

_PLACES = (
    "array<struct<name:string,latitude:double,longitude:double,place_type:string>>"
)


def accept(attempts, max_retries=MAX_RETRIES):
    """AGG-10, FLT-18, STR-11 (Q-24): (correlation_id, body, attempts).

    ``attempt`` numbers the HTTP answers of a drop; a lost connection is no
    answer and is tried without end.  The first 200 counts if no more than
    ``max_retries`` failures came before it; otherwise ``body`` is NULL.
    """
    good = (F.col("status") == 200) & (F.col("attempt") <= max_retries + 1)
    return attempts.groupBy("correlation_id").agg(
        F.min_by("body", F.when(good, F.col("attempt"))).alias("body"),
        F.count(F.lit(1)).alias("attempts"),
    )


def tags_of(body):
    """PRJ-13: every list of the answer but the places, as (tag_type, tag_name)."""
    lists = F.map_filter(
        F.from_json(body, "map<string,string>"), lambda k, _: k != "places"
    )
    nested = F.transform(
        F.map_entries(lists),
        lambda e: F.transform(
            F.from_json(e["value"], "array<string>"),
            lambda name: F.struct(
                e["key"].alias("tag_type"), name.alias("tag_name")
            ),
        ),
    )
    return F.flatten(F.filter(nested, lambda x: x.isNotNull()))


def places_of(body):
    """PRJ-12: NULL if the answer has no such key, ``array()`` if it is empty."""
    raw = F.get_json_object(body, "$.places")
    return F.transform(
        F.from_json(raw, _PLACES),
        lambda p: F.struct(
            p["name"].alias("place_name"),
            p["latitude"].alias("latitude"),
            p["longitude"].alias("longitude"),
            p["place_type"].alias("place_type"),
            F.lit(PLACE_SOURCE).alias("source"),
        ),
    )


def attach(drops, accepted, id_column="correlation_id"):
    """JOIN-16, FLT-13, PRJ-8: drops with tags and places, all stamped complete.

    A drop without raw text, or complete before, is passed on as it is.
    """
    answers = accepted.select(
        F.col("correlation_id").alias(id_column), F.col("body").alias("_body")
    )
    joined = drops.join(answers, id_column, "left")
    done = (
        F.coalesce("semantics_complete", F.lit(False))
        if "semantics_complete" in drops.columns
        else F.lit(False)
    )
    asked = (
        F.col("droplet_raw").isNotNull() & ~done & F.coalesce(
            F.length("_body") > 0, F.lit(False)
        )
    )
    body = F.when(asked, F.col("_body"))

    def kept(name, new):
        return F.coalesce(new, F.col(name)) if name in drops.columns else new

    return joined.withColumns(
        {
            "tags": kept("tags", tags_of(body)),
            "places": kept("places", places_of(body)),
            "semantics_complete": F.lit(True),
            "source": F.lit("semantics"),
        }
    ).drop("_body")
