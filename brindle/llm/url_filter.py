"""URL filters by a Bloom filter cascade, in DataFrame expressions only.

The cascade tells listed keys from all other keys of a known universe, exactly.
Level 0 is a Bloom filter of the listed keys R. Its false positives among the
rest S of the universe go into level 1, those of level 1 among R into level 2,
and so on, until a level has none. A key of the universe is in R if the first
level that lacks it is odd, or if it passes all levels and their number is odd.
Judging a row tests bits of constants: no join, and no shuffle.

Levels are built from the distinct keys, which a partial aggregate makes before
anything moves, so a host with a third of all pages costs one row per task. A level
is one job: keys that pass all levels before set their bits, gathered word by word
with ``bit_or``. Level 0 passes a share sqrt(1/2) r / s of the s keys that aren't
listed, for r listed ones, and each later level half, which makes the levels
smallest together; later levels are sized by these shares. After two levels, keys
that pass all are written out once they are expected to be ``FEW`` at most. The
total of bits is bounded by ``MAX_BITS``; beyond it nothing is collected, and
``judge`` looks hosts up by a join with the distinct keys instead.

The list is a DataFrame of domains. It meets the distinct hosts and their parent
domains, of no more labels than its longest domain has, by a join, whose sides the
planner sizes.

Rules come first: a rule (verdict, host, path) fits its host and all subdomains
if the path of the url starts with the rule's path; the longest host and path
wins, block before allow among equal ones. Where no rule fits, membership of the
host in the list decides: listed hosts and their subdomains are blocked.

Defined results: a null url or one without ``://`` has an empty host and path,
fits no rule, and is allowed unless the empty key is listed; repeated rows are
all judged; very long urls are taken whole; nulls and repeats in the list change
nothing; an empty table or an empty list gives a cascade that lists nothing.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame

from brindle.llm.common import dropped, lower_ascii, shaped, staged

#: Bits of all levels together that a plan may carry: 4 MB.
MAX_BITS = 1 << 25
#: Share of false positives of the levels after the first, and the most of the first.
RATE = 0.5
#: Keys that pass all levels and are written out instead of further levels.
FEW = 512


class TooLong(ValueError):
    """The list needs more bits than a plan may carry."""


@dataclass(frozen=True)
class Level:
    bits: int
    hashes: int
    words: str  # 64-bit words, as decimal numbers joined by commas
    listed: tuple[str, ...] | None = None  # the last level: the listed among the keys that pass all others


def _positions(key: Column, level: int, bits: int, hashes: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(level), F.lit(i)), F.lit(bits)) for i in range(hashes)]


def _passes(key: Column, number: int, level: Level) -> Column:
    words = F.split(F.lit(level.words), ",").cast("array<bigint>")
    out = F.lit(True)
    for at in _positions(key, number, level.bits, level.hashes):
        word = F.get(words, F.shiftright(at, 6).cast("int"))
        out = out & (F.getbit(word, at.bitwiseAND(F.lit(63)).cast("int")) == 1)
    return out


def _remaining(key: Column, levels: list[Level]) -> Column:
    out = F.lit(True)
    for number, level in enumerate(levels):
        out = out & _passes(key, number, level)
    return out


def cascade(keys: DataFrame, max_bits: int = MAX_BITS, few: int = FEW) -> list[Level]:
    """Levels for ``keys`` (key string, listed boolean), one row per key of the whole universe."""
    keys = staged(keys.select("key", "listed"), "url-keys")
    counts = {r["listed"]: r["n"] for r in keys.groupBy("listed").agg(F.count(F.lit(1)).alias("n")).collect()}
    expected = {True: float(counts.get(True, 0)), False: float(counts.get(False, 0))}
    levels: list[Level] = []
    spent, side = 0, True
    while expected[side]:
        left = keys.where(_remaining(F.col("key"), levels))
        if len(levels) > 1 and sum(expected.values()) <= few:
            rows = left.limit(8 * few + 1).collect()
            if len(rows) <= 8 * few:
                levels.append(Level(0, 0, "", tuple(sorted(r["key"] for r in rows if r["listed"]))))
                break
        rate = RATE if levels else min(RATE, math.sqrt(0.5) * expected[True] / max(1.0, expected[False]))
        n = max(1.0, expected[side])
        bits = max(1, math.ceil(-n * math.log(rate) / math.log(2) ** 2))
        hashes = max(1, round(bits / n * math.log(2)))
        spent += bits
        if spent > max_bits:
            dropped(keys)
            raise TooLong(f"the cascade needs over {max_bits} bits for {n:.0f} keys at level {len(levels)}")
        at = left.where(F.col("listed") == side).select(F.explode(F.array(*_positions(F.col("key"), len(levels), bits, hashes))).alias("at"))
        rows = at.groupBy(F.shiftright("at", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("bits")).collect()
        if not rows:
            break
        words = ["0"] * (bits // 64 + 1)
        for r in rows:
            words[r["word"]] = str(r["bits"])
        levels.append(Level(bits, hashes, ",".join(words)))
        expected[not side] *= rate
        side = not side
    dropped(keys)
    return levels


def listed_in(key: Column, levels: list[Level]) -> Column:
    """Whether a key of the universe is listed."""
    last = levels[-1].listed if levels else None
    out = F.lit(len(levels) % 2 == 1) if last is None else key.isin(*last) if last else F.lit(False)
    for number in range(len(levels) - 1 - (last is not None), -1, -1):
        out = F.when(_passes(key, number, levels[number]), out).otherwise(F.lit(number % 2 == 1))
    return out


def host_of(url: str = "url") -> Column:
    rest = _rest(url)
    return lower_ascii(F.coalesce(F.regexp_extract(rest, r"^[^/?#]*", 0), F.lit("")))


def path_of(url: str = "url") -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*+([^?#]*)", 1), F.lit(""))


def _rest(url: str) -> Column:
    at = F.locate("://", F.col(url))
    return F.when(at > 0, F.substr(F.col(url), at + 3))


def suffixes(host: str, depth: int) -> Column:
    """The last ``depth`` labels of a host, of the last one to all of them."""
    return F.expr(f"transform(sequence(1, least({depth}, size(split({host}, '[.]', -1)))), i -> substring_index({host}, '.', -i))")


def with_rules(pages: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """``pages`` (host, path) plus ``rule`` and ``ruled``, of the longest of ``rules`` (verdict, host, path) that fits."""
    ordered = sorted(rules, key=lambda r: (-len(r[1]), -len(r[2]), r[0] != "block", r))
    rule, ruled = F.lit(None).cast("string"), F.lit(None).cast("string")
    for verdict, host, path in reversed(ordered):
        fits = ((F.col("host") == host) | F.endswith("host", F.lit("." + host))) & F.startswith("path", F.lit(path))
        rule, ruled = F.when(fits, F.lit(host + path)).otherwise(rule), F.when(fits, F.lit(verdict)).otherwise(ruled)
    return pages.withColumns({"rule": rule, "ruled": ruled})


def universe(pages: DataFrame, block_list: DataFrame) -> DataFrame:
    """Every distinct host of ``pages`` and whether it, or a parent domain, is among the ``domain`` of ``block_list``."""
    hosts = shaped(pages, ["url"]).select(host_of().alias("key")).distinct()
    domains = shaped(block_list, ["domain"]).select(F.col("domain").alias("suffix"))
    depth = domains.agg(F.max(F.size(F.split("suffix", "[.]", -1)))).first()[0] or 0
    if not depth:
        return hosts.select("key", F.lit(False).alias("listed"))
    listed = hosts.select("key", F.explode(suffixes("key", depth)).alias("suffix")).join(domains, "suffix", "left_semi").select("key").distinct()
    return hosts.join(listed.withColumn("listed", F.lit(True)), "key", "left").select("key", F.coalesce("listed", F.lit(False)).alias("listed"))


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], block_list: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``pages`` plus ``host``, ``path``, ``rule`` and ``verdict``; ``block_list`` has a column ``domain``."""
    out = shaped(pages, ["url"], ["host", "path", "rule", "ruled", "verdict", "_key", "_listed"])
    out = with_rules(out.withColumns({"host": host_of(), "path": path_of()}), rules)
    keys = universe(pages, block_list)
    try:
        out = out.withColumn("_listed", listed_in(F.col("host"), cascade(keys, max_bits)))
    except TooLong:
        out = out.join(keys.select(F.col("key").alias("_key"), F.col("listed").alias("_listed")), F.col("host") == F.col("_key")).drop("_key")
    method = F.when(F.col("_listed"), "block").otherwise("allow")
    return out.withColumn("verdict", F.coalesce("ruled", method)).drop("ruled", "_listed")
