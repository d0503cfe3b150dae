r"""URL filters: rules by host and path, and a list of URLs behind a blocked Bloom filter.

A rule ``(verdict, host, path)`` fits a URL of its host or any subdomain whose path starts
with the rule's; of several that fit the longest ``host + path`` decides, then the longer
host, then the first given.  URLs without a rule are looked up in a list: both sides are made canonical, a
blocked Bloom filter of the listed ones lets possible hits through, and only those are
joined with the list itself, which removes the false positives.

The filter is a table of 512-bit blocks, eight 64-bit words each; a URL's hash names its
block and one bit of every word.  It has ``BITS`` bits per listed URL but never more than
``MOST_BLOCKS`` blocks (16 MB of bits), so it can be broadcast whatever the list's length;
a longer list only makes more false positives for the join.  The join of the possible hits
spreads URLs that very many rows share.

Canonical: scheme dropped, host in lower case without ``www.`` and default port, fragment
and tracking parameters dropped, the other parameters sorted, no slash or ``.html`` at the end of
the path.  Defined results: a null URL, or one without ``://``, has empty host and path,
no canonical form and is not listed; null and such entries of the list are ignored;
repeated rows are judged alike; with an empty list everything without a rule is allowed;
columns of the input keep their names, those it shares with the added ones are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltworks.functions.joins import join_spread
from siltworks.llm.tables import digest, quoted, store

BITS = 16
WORDS = 8
MOST_BLOCKS = 1 << 18

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Query parameters that only track visitors.
TRACKING = r"^(utm_[^=]*|ref|fbclid|gclid)(=|$)"

Rule = tuple[str, str, str]
ADDED = ["host", "path", "canonical", "rule", "verdict"]


def split_url(url: Column) -> tuple[Column, Column, Column]:
    """Host, path and query of a URL; empty where it has none."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.regexp_extract(rest, r"^[^?#]*\?([^#]*)", 1)


def canonical(url: Column) -> Column:
    """The form under which URLs are listed and looked up; null without ``://``."""
    host, path, query = split_url(url)
    place = F.regexp_replace(F.regexp_replace(host, r"^www\.", ""), r":(80|443)$", "")
    page = F.regexp_replace(path, r"(\.html|/+)$", "")
    told = F.filter(F.split(query, "&", -1), lambda p: (p != "") & ~p.rlike(TRACKING))
    asked = F.array_join(F.array_sort(told), "&")
    whole = F.concat(place, page, F.when(asked == "", "").otherwise(F.concat(F.lit("?"), asked)))
    return F.when(F.locate("://", url) > 0, whole)


def rule_for(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """The deciding rule, written host + path, and its verdict; null where none fits."""
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), -len(r[1])))
    name = verdict = F.lit(None).cast("string")
    for said, at, start in reversed(ordered):
        fits = ((host == at) | host.endswith("." + at)) & path.startswith(start)
        name, verdict = F.when(fits, at + start).otherwise(name), F.when(fits, said).otherwise(verdict)
    return name, verdict


def _place(key: str, blocks: int) -> list[Column]:
    """Block number and the bit of each word for a key."""
    first, second = digest(key)
    bit = [F.shiftrightunsigned(second, 6 * i).bitwiseAND(F.lit(63).cast("long")).cast("int") for i in range(WORDS)]
    return [F.pmod(first, F.lit(blocks)).alias("_block")] + [F.call_function("shiftleft", F.lit(1).cast("long"), b).alias(f"_b{i}") for i, b in enumerate(bit)]


def blocked_bloom(keys: DataFrame, key: str, count: int, bits: int = BITS, most_blocks: int = MOST_BLOCKS) -> tuple[DataFrame, int]:
    """The filter of ``count`` keys as rows (_block, _w0 .. _w7), at most ``most_blocks``, and its number of blocks."""
    blocks = max(1, min(most_blocks, -(-count * bits // (64 * WORDS))))
    rows = keys.select(*_place(key, blocks))
    return rows.groupBy("_block").agg(*[F.bit_or(f"_b{i}").alias(f"_w{i}") for i in range(WORDS)]), blocks


def mark_possible(rows: DataFrame, key: str, bloom: DataFrame, blocks: int, name: str) -> DataFrame:
    """Add ``name``: whether the filter may hold the row's key; false for null keys."""
    named = [quoted(c) for c in rows.columns]
    probed = rows.select(*named, *_place(key, blocks)).join(F.broadcast(bloom), "_block", "left")
    hit = F.col(key).isNotNull()
    for i in range(WORDS):
        hit = hit & (F.col(f"_w{i}").bitwiseAND(F.col(f"_b{i}")) != 0)
    return probed.select(*named, F.coalesce(hit, F.lit(False)).alias(name))


def judge_urls(
    df: DataFrame, listed: DataFrame, rules: Sequence[Rule] = (), url: str = "url", listed_url: str = "url", most_blocks: int = MOST_BLOCKS
) -> DataFrame:
    """``df`` with ``host``, ``path``, ``canonical``, ``rule`` and ``verdict``.

    ``rules`` is a short sequence that becomes an expression; ``listed`` is a table of any
    size.  Without a rule the verdict is ``block`` for listed URLs and ``allow`` for others.
    """
    held = [c for c in df.columns if c.lower() not in ADDED or c == url]
    names = {c: f"c{i}" for i, c in enumerate(held)}
    plain = df.select(*[quoted(c).alias(n) for c, n in names.items()])
    address = F.col(names[url])
    host, path, _ = split_url(address)
    rule, said = rule_for(F.col("host"), F.col("path"), rules)
    rows = plain.withColumns({"host": host, "path": path, "canonical": canonical(address)}).withColumns({"rule": rule, "said": said})

    entries = store(listed.select(canonical(quoted(listed_url)).alias("entry")).dropna().distinct(), "listed-urls")
    bloom, blocks = blocked_bloom(entries, "entry", entries.count(), most_blocks=most_blocks)
    bloom = store(bloom, "url-filter")
    # a rule decides alone, so only the others are looked up
    asked = rows.withColumn("asked", F.when(F.col("rule").isNull(), F.col("canonical")))
    probed = mark_possible(asked, "asked", bloom, blocks, "possible")
    hits = probed.filter("possible")
    confirmed = join_spread(hits, entries.select(F.col("entry").alias("asked"), F.lit(True).alias("listed")), ["asked"])
    judged = confirmed.unionByName(probed.filter("NOT possible").withColumn("listed", F.lit(None).cast("boolean")))
    verdict = F.coalesce("said", F.when(F.coalesce("listed", F.lit(False)), "block").otherwise("allow"))
    kept = [F.col(n).alias(c) for c, n in names.items() if c.lower() not in ADDED]
    return judged.select(*kept, "host", "path", "canonical", "rule", verdict.alias("verdict"))
