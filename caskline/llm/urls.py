"""URL filters: dated list entries as validity intervals, joined as of each capture's fetch time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Kinds of list keys: a path's first segment on a host, a host, a domain (or top level) with all below it.
PREFIX, HOST, DOMAIN = "p:", "h:", "d:"


def url_host(url: Column) -> Column:
    """Host of an absolute URL in lower case, without user, port and a final dot; empty if there is none."""
    host = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^:/?#]+)", 1)
    return F.regexp_replace(F.lower(host), r"\.$", "")


def url_segment(url: Column) -> Column:
    """First segment of the path; empty if there is none."""
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^/?#]+)", 1)


def url_keys(url: Column) -> Column:
    """(key, rank) of every list key that can concern a URL, the more specific the higher its rank."""
    host, segment = url_host(url), url_segment(url)
    labels = F.split(host, r"\.")
    domains = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.struct(
            F.concat(F.lit(DOMAIN), F.array_join(F.slice(labels, i, F.size(labels)), ".")).alias("key"),
            (F.size(labels) - i + 1).alias("rank"),
        ),
    )
    exact = F.array(
        F.struct(F.concat(F.lit(HOST), host).alias("key"), F.lit(1000).alias("rank")),
        F.struct(F.concat(F.lit(PREFIX), host, F.lit("/"), segment).alias("key"), F.lit(2000).alias("rank")),
    )
    return F.when(F.coalesce(host, F.lit("")) != "", F.concat(exact, domains))


def validity_intervals(entries: DataFrame) -> DataFrame:
    """Turn dated entries (key, since, verdict) into (key, verdict, valid_from, valid_to).

    An entry holds from its date until the key's next one, the last without end (null). Of several on
    one day block beats allow beats remove; other verdicts, null keys and null dates are left out.
    'remove' ends what held before and gives no interval. A key has one row a day at most, which
    bounds its window.
    """
    strength = F.when(F.col("verdict") == "block", 3).when(F.col("verdict") == "allow", 2).when(F.col("verdict") == "remove", 1)
    days = (
        entries.select("key", F.col("since").cast("date").alias("valid_from"), strength.alias("s"))
        .where("key is not null and valid_from is not null and s is not null")
        .groupBy("key", "valid_from")
        .agg(F.max("s").alias("s"))
    )
    later = F.lead("valid_from").over(Window.partitionBy("key").orderBy("valid_from"))
    return (
        days.withColumn("valid_to", later)
        .where("s > 1")
        .select("key", F.when(F.col("s") == 3, "block").otherwise("allow").alias("verdict"), "valid_from", "valid_to")
    )


def filter_as_of(captures: DataFrame, entries: DataFrame, url_col: str = "url", time_col: str = "fetched") -> DataFrame:
    """Judge each capture by the list entries that held when it was fetched.

    Adds verdict ('block', 'allow' or null), matched_key, listed_on and kept. Of the active keys the
    most specific decides: path segment, host, then the longest domain. Captures without URL, host or
    fetch time match nothing and are kept. A key's intervals meet a capture as one array, so the join
    makes no more rows than the captures have keys; equal captures (URL and time) are judged once.
    Columns of these names in ``captures`` are replaced.
    """
    added = ("verdict", "matched_key", "listed_on", "kept")
    columns = [captures[c] for c in captures.columns if c not in added]
    rows = captures.select(
        F.struct(*columns).alias("_row"), F.col(url_col).alias("_page"), F.col(time_col).cast("date").alias("_day")
    )
    lists = (
        validity_intervals(entries)
        .groupBy("key")
        .agg(F.sort_array(F.collect_list(F.struct("valid_from", "valid_to", "verdict"))).alias("_held"))
    )
    visits = rows.select(F.col("_page").alias("_url"), F.col("_day").alias("_at")).where("_url is not null and _at is not null").distinct()
    active = F.get(
        F.filter(
            "_held",
            lambda x: (x["valid_from"] <= F.col("_at")) & (x["valid_to"].isNull() | (F.col("_at") < x["valid_to"])),
        ),
        F.lit(0),
    )
    judged = (
        visits.select("_url", "_at", F.explode(url_keys(F.col("_url"))).alias("_k"))
        .select("_url", "_at", F.col("_k.key").alias("key"), F.col("_k.rank").alias("_rank"))
        .join(lists, "key")
        .withColumn("_hit", active)
        .where("_hit is not null")
        .groupBy("_url", "_at")
        .agg(F.max(F.struct("_rank", "key", "_hit")).alias("_best"))
    )
    return rows.join(judged, (F.col("_page") == F.col("_url")) & (F.col("_day") == F.col("_at")), "left").select(
        "_row.*",
        F.col("_best._hit.verdict").alias("verdict"),
        F.col("_best.key").alias("matched_key"),
        F.col("_best._hit.valid_from").alias("listed_on"),
        (F.coalesce(F.col("_best._hit.verdict"), F.lit("allow")) != "block").alias("kept"),
    )
