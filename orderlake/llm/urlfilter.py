"""URL filters as a temporal list join.

Lists change: an entry is added on one day and removed on another. Dated changes become
validity intervals, and a capture is judged by the entries that were valid when it was
fetched, not by those of today. All of it is joins, windows and aggregates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOST = r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)"


def host_of(url: Column) -> Column:
    """The host of an absolute URL in lower case without a final dot; empty if there is none."""
    return F.rtrim(F.regexp_extract(F.lower(url), HOST, 1), F.lit("."))


def keys_of(url: Column) -> Column:
    """What an entry may name: the URL without its fragment, and the host with each of its
    parent domains (a domain entry covers its subdomains). No keys for a null URL."""
    labels = F.split(host_of(url), r"\.")
    domains = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.concat(F.lit("domain:"), F.array_join(F.slice(labels, i, F.size(labels)), ".")),
    )
    page = F.array(F.concat(F.lit("url:"), F.regexp_replace(url, "#.*$", "")))
    return F.array_distinct(F.when(host_of(url) == "", page).otherwise(F.concat(page, domains)))


def validity(changes: DataFrame) -> DataFrame:
    """(list_name, policy, key, valid_from, valid_to) from (list_name, policy, key, action, at).

    An ``add`` is valid from its time to the next ``remove``, or without end (null). Repeated
    adds and removes count once; of changes at one time the add holds. Rows with a null are
    left out. policy: ``block`` or ``allow``. The history of an entry is grouped by entry
    and time first, so a change that is told many times costs one row.
    """
    entry = ["list_name", "policy", "key"]
    # add > remove is wrong in the alphabet, so take whether there is any add.
    dated = (
        changes.select(*entry, "action", "at").dropna()
        .where(F.col("action").isin("add", "remove"))
        .groupBy(*entry, "at")
        .agg(F.max((F.col("action") == "add").cast("int")).alias("on"))
    )
    in_time = Window.partitionBy(*entry).orderBy("at")
    turned = dated.withColumn("before", F.coalesce(F.lag("on").over(in_time), F.lit(0))).where("on <> before")
    return (
        turned.withColumn("valid_to", F.lead("at").over(in_time))
        .where("on = 1")
        .select(*entry, F.col("at").alias("valid_from"), "valid_to")
    )


def judged(
    captures: DataFrame,
    changes: DataFrame,
    *,
    url_col: str = "url",
    time_col: str = "fetched_at",
) -> DataFrame:
    """The captures with ``n_block``, ``n_allow`` (valid entries that cover them when fetched),
    ``lists`` (names of the blocking lists, sorted, comma-joined) and ``blocked``.

    A capture is blocked if a block entry covers it and no allow entry does. A null URL or
    time is covered by nothing. All rows and columns stay, repeated rows too. Equal captures
    are joined once: the lists see distinct (url, time) pairs, and a frequent host is split
    by adaptive execution, since only its captures' side is large.
    """
    url, at = F.col(f"`{url_col}`"), F.col(f"`{time_col}`")
    distinct = captures.select(url.alias("_url"), at.alias("_at")).dropna().distinct()
    keyed = distinct.withColumn("_key", F.explode(keys_of(F.col("_url"))))
    valid = validity(changes).select(
        F.col("key").alias("_key"), "list_name", "policy", "valid_from", "valid_to"
    )
    covered = (
        keyed.join(valid, "_key")
        .where((F.col("_at") >= F.col("valid_from")) & (F.col("valid_to").isNull() | (F.col("_at") < F.col("valid_to"))))
        .groupBy("_url", "_at")
        .agg(
            F.count(F.when(F.col("policy") == "block", 1)).alias("n_block"),
            F.count(F.when(F.col("policy") == "allow", 1)).alias("n_allow"),
            F.array_join(
                F.array_sort(F.collect_set(F.when(F.col("policy") == "block", F.col("list_name")))), ","
            ).alias("lists"),
        )
    )
    none = F.lit(0).cast("long")
    own = captures.alias("own")
    found = covered.select(F.struct("*").alias("_found"))
    got = lambda c: F.col(f"_found.{c}")
    return own.join(
        found,
        (F.col(f"own.`{url_col}`") == got("_url")) & (F.col(f"own.`{time_col}`") == got("_at")),
        "left",
    ).select(
        "own.*",
        F.coalesce(got("n_block"), none).alias("n_block"),
        F.coalesce(got("n_allow"), none).alias("n_allow"),
        F.coalesce(got("lists"), F.lit("")).alias("lists"),
        (F.coalesce(got("n_block") > 0, F.lit(False)) & F.coalesce(got("n_allow") == 0, F.lit(True))).alias("blocked"),
    )
