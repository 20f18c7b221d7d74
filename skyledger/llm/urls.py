"""URL filter: a blocked Bloom filter in front of an exact join with listed URLs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Blocks of 256 bits. The filter is broadcast, and this bounds it to about 3 MB whatever
# is listed; a list too long for it costs more exact look-ups, never a wrong answer.
FILTER_BLOCKS = 65_536
LANES = 4

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, "://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def _lane_bits(key: Column) -> list[Column]:
    """One bit of each lane of the key's block."""
    turned = F.xxhash64(key, F.lit("lanes"))
    return [
        F.call_function(
            "shiftleft",
            F.lit(1).cast("long"),
            F.pmod(F.shiftright(turned, 6 * lane), F.lit(64)).cast("int"),
        )
        for lane in range(LANES)
    ]


def _block(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(FILTER_BLOCKS)).cast("int")


def bloom_filter(listed: DataFrame) -> DataFrame:
    """(block, lane_0, ...): the bits of every listed key, at most a row per block."""
    lanes = _lane_bits(F.col("key"))
    return (
        listed.select(
            _block(F.col("key")).alias("block"),
            *(bits.alias(f"lane_{k}") for k, bits in enumerate(lanes)),
        )
        .groupBy("block")
        .agg(*(F.bit_or(f"lane_{k}").alias(f"lane_{k}") for k in range(LANES)))
    )


def judge(
    pages: DataFrame, listed: DataFrame, default: str = "allow"
) -> DataFrame:
    """(page_id, host, path, rule, verdict), a row for each page.

    ``listed`` has ``rule``, a host in lower case and a path, and ``verdict``. A path that
    ends in a slash (``net/``) fits its host and all subdomains where the page's path
    starts with the rule's; any other (``net/x.html``) is a page and fits exactly this
    host and path. Rules of another form, without a path or with a query, are an error;
    null rules are ignored. The longest rule wins, of equally long ones the last in order of
    text, and of two verdicts for one rule the last (block). Where none fits the
    verdict is ``default`` and the rule is null.

    Each page is looked up under its host's suffixes and its path's leading folders, no
    more of either than the longest listed rule has, through the Bloom filter and then
    by an exact join of what passes. A url that is null or has no ``://`` has an empty
    host and path, which no rule fits. Repeated pages stay repeated, other columns are
    ignored, and empty tables give an empty result or the default.
    """
    listed = (
        listed.select(F.col("rule").alias("key"), "verdict")
        .filter(F.col("key").isNotNull())
        .groupBy("key")
        .agg(F.max("verdict").alias("verdict"))
    )
    depth = listed.agg(
        F.max(F.size(F.split(F.substring_index("key", "/", 1), r"\."))),
        F.max(F.size(F.split("key", "/")) - 1),
        F.max(F.when(~F.col("key").rlike("^[^/?#A-Z]+/[^?#]*$"), F.col("key"))),
    ).first()
    if depth[2] is not None:
        raise ValueError(f"no host in lower case and path: {depth[2]!r}")
    labels, folders = depth[0] or 1, depth[1] or 1
    parted = pages.select(
        "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")
    )
    dots, slashes = F.size(F.split("host", r"\.")), F.size(F.split("path", "/")) - 1
    hosts = F.transform(
        F.sequence(F.lit(1), F.least(F.lit(labels), dots)),
        lambda k: F.call_function("substring_index", F.col("host"), F.lit("."), -k),
    )
    paths = F.transform(
        F.sequence(F.lit(1), F.least(F.lit(folders), slashes)),
        lambda k: F.concat(
            F.call_function("substring_index", F.col("path"), F.lit("/"), k), F.lit("/")
        ),
    )
    keys = F.flatten(
        F.transform(hosts, lambda h: F.transform(paths, lambda p: F.concat(h, p)))
    )
    page = F.when(~F.endswith("path", F.lit("/")), F.array(F.concat("host", "path")))
    keys = F.concat(keys, F.coalesce(page, F.array().cast("array<string>")))
    bits = _lane_bits(F.col("key"))
    hits = (
        parted.filter((F.col("host") != "") & (slashes > 0))
        .select("host", "path", F.explode(keys).alias("key"))
        .withColumn("block", _block(F.col("key")))
        .join(F.broadcast(bloom_filter(listed)), "block")
    )
    for k in range(LANES):
        hits = hits.filter(F.col(f"lane_{k}").bitwiseAND(bits[k]) == bits[k])
    best = (
        hits.join(listed, "key")
        .groupBy("host", "path")
        .agg(F.max(F.struct(F.length("key"), "key", "verdict")).alias("best"))
    )
    return parted.join(best, ["host", "path"], "left").select(
        "page_id",
        "host",
        "path",
        F.col("best.key").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )
