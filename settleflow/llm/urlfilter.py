"""URL rules by blocked Bloom filter and exact hash join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from settleflow.llm.tables import filled, lower_ascii, written

#: Words of 32 bits in a block; every key sets one bit in each.
LANES = 8
#: Keys a block is laid out for: 16 bits a key, of others about one in 500 passes.
BLOCK_KEYS = 16
#: Largest filter that is broadcast, under 100 bytes a block; a larger one is shuffled by block.
BROADCAST_BLOCKS = 1 << 18


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return lower_ascii(F.regexp_extract(filled(url), r"(?s)^.*?://([^/?#]*)", 1))


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(filled(url), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _block(blocks: int) -> Column:
    return F.pmod(F.xxhash64("_host", "_path"), F.lit(blocks)).cast("int")


def _bit(lane: int) -> Column:
    """The bit of the key in one word of its block, five bits of a second hash for each word."""
    at = F.shiftrightunsigned(F.xxhash64(F.lit("bit"), "_path", "_host"), 5 * lane).bitwiseAND(F.lit(31))
    return F.call_function("shiftleft", F.lit(1).cast("long"), at.cast("int"))


def filter_blocks(keys: int) -> int:
    """Blocks of a filter of that many keys: a power of two, so that about one in 500 others passes."""
    return 1 << max(0, (max(keys, 1) - 1) // BLOCK_KEYS).bit_length()


def blocked_bloom(keys: DataFrame, blocks: int) -> DataFrame:
    """The filter of ``_host``, ``_path`` as a table of at most ``blocks`` rows of eight words."""
    lanes = [F.bit_or(_bit(i)).alias(f"_w{i}") for i in range(LANES)]
    return keys.groupBy(_block(blocks).alias("_block")).agg(*lanes)


def passes(keys: DataFrame, bloom: DataFrame, blocks: int) -> DataFrame:
    """The keys the filter lets through: all listed ones and a few others.

    ``bloom`` has at most ``blocks`` rows of under 100 bytes, whatever the pages. It is broadcast up to
    ``BROADCAST_BLOCKS``; a larger one is joined by block in a shuffle, or as Spark's own size check says.
    """
    hit = [F.col(f"_w{i}").bitwiseAND(_bit(i)) != 0 for i in range(LANES)]
    side = F.broadcast(bloom) if blocks <= BROADCAST_BLOCKS else bloom
    found = keys.withColumn("_block", _block(blocks)).join(side, "_block")
    for condition in hit:
        found = found.where(condition)
    return found.select(keys.columns)


def judge_urls(
    pages: DataFrame, rules: DataFrame, id: str = "page_id", url: str = "url", blocks: int | None = None
) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict`` for every page.

    ``rules`` has ``host``, ``path`` and ``verdict`` (``allow`` or ``block``) of every listed
    canonical URL. A rule fits its host and all subdomains if the path of the URL starts with its
    path. The longest fitting rule decides (host and path together; of equals the longer host). A
    page that no listed URL fits is allowed. Of repeated rules, ``block`` counts.

    The keys of a page are its host and parent domains with the prefixes of its path, as many labels
    and characters as some rule has. A blocked Bloom filter of the listed hosts goes first, so that a path is taken
    apart only for hosts that have a rule; one of hosts and paths removes nearly all other keys. What passes
    meets the rules in an exact join. Both filters are sized by the number of rules, 16 bits each, unless ``blocks``
    is given. This is done once per distinct host and path, counted
    inside map tasks first; pages then look their host and path up in the written answer, a join
    that adaptive execution splits under a hot host.

    A null URL or one without ``://`` has an empty host and path and is allowed. Null ids and
    repeated rows pass through, one output row each. Empty tables of pages or rules are fine: no rows, or
    every page allowed. Other columns of both tables are ignored.
    """
    listed = (
        rules.select(
            lower_ascii(filled(F.col("host"))).alias("_host"),
            filled(F.col("path")).alias("_path"),
            F.col("verdict").alias("_verdict"),
        )
        .groupBy("_host", "_path")
        .agg(F.max("_verdict").alias("_verdict"))
    )
    listed = written(listed, "url-rules")
    # The sets are bounded by the longest host and path of a rule, not by their number.
    shape = listed.agg(
        F.collect_set(F.size(F.split("_host", r"\."))).alias("labels"),
        F.collect_set(F.length("_path")).alias("lengths"),
        F.count(F.lit(1)).alias("rules"),
    ).first()
    blocks = blocks or filter_blocks(shape["rules"])
    of_page = pages.select(F.col(id).alias("page_id"), url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path"))
    distinct = of_page.select("host", "path").distinct().where("host <> ''")
    parts = F.split("host", r"\.")
    hosts = F.array(*[F.when(F.size(parts) >= n, F.concat_ws(".", F.slice(parts, -n, n))) for n in sorted(shape["labels"])])
    paths = F.array(*[F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in sorted(shape["lengths"])])
    if not shape["labels"]:
        hosts = paths = F.array().cast("array<string>")
    whole = F.lit("").alias("_path")
    of_hosts = blocked_bloom(listed.select("_host", whole).distinct(), blocks)
    domains = distinct.withColumn("_host", F.explode(F.array_compact(hosts))).withColumn("_path", whole)
    known = passes(domains, of_hosts, blocks)
    keys = known.withColumn("_path", F.explode(F.array_compact(paths)))
    hits = passes(keys, blocked_bloom(listed, blocks), blocks)
    best = F.max_by(
        F.struct("_host", "_path", "_verdict"), F.struct(F.length("_host") + F.length("_path"), F.length("_host"))
    )
    decided = written(
        hits.join(listed, ["_host", "_path"])
        .groupBy("host", "path")
        .agg(best.alias("_best"))
        .select(F.col("host").alias("_of_host"), F.col("path").alias("_of_path"), "_best"),
        "url-decided",
    )
    return of_page.join(
        decided, (F.col("host") == F.col("_of_host")) & (F.col("path") == F.col("_of_path")), "left"
    ).select(
        "page_id",
        "host",
        "path",
        F.concat("_best._host", "_best._path").alias("rule"),
        F.coalesce("_best._verdict", F.lit("allow")).alias("verdict"),
    )
