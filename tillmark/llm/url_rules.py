"""URL rules as Bloom filter cascades, in Spark SQL only.

A rule is a host and a path start, as in ``example.net/en/``. It fits its host
and all subdomains if the path starts with the rule's; of several the longest
wins, of equally long ones that with the longer host.

A URL has few keys a rule could equal: each of its host's endings (as many
labels as the rules have) with each path start (of the lengths the rules have).
All keys of the corpus form the universe. Per verdict a cascade is built over
it: level 1 holds the listed keys, level 2 the unlisted keys that level 1 lets
through, level 3 the listed keys that level 2 lets through, and so on until
nothing is let through. Membership is then exact for every key of the universe,
without a join: the filter words are literals in the plan. Rules are given on
the driver, ``MAX_RULES`` at most, which bounds level 1; later levels shrink.

Defined results: null URLs and those without ``://`` have an empty host and path
and fit no rule; URLs that fit no rule are allowed; a rule list may be empty;
repeated rows are judged alike; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MAX_RULES = 100_000
FIRST_RATE, RATE = 0.01, 0.5

RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}


def with_parts(pages: DataFrame, url: str = "url") -> DataFrame:
    """Adds host and path of the URL."""
    rest = f"if(instr({url}, '://') > 0, substring({url}, instr({url}, '://') + 3), '')"
    return pages.withColumn("tm_rest", F.coalesce(F.expr(rest), F.lit(""))).withColumns({
        "host": F.expr(f"translate(regexp_extract(tm_rest, '^[^/?#]*', 0), '{UPPER}', '{LOWER}')"),
        "path": F.expr("regexp_extract(tm_rest, '^[^/?#]*([^?#]*)', 1)"),
    }).drop("tm_rest")


def keys_sql(rules: dict[str, str]) -> str:
    """SQL array of the keys of a URL, the longest first."""
    hosts = {r.partition("/")[0] for r in rules}
    lengths = sorted({len(r) - len(r.partition("/")[0]) for r in rules})
    labels = max((h.count(".") + 1 for h in hosts), default=0)
    parts = [
        f"if(length(path) >= {n} and length(host) - length(replace(host, '.', '')) >= {k - 1}, "
        f"concat(substring_index(host, '.', -{k}), substring(path, 1, {n})), null)"
        for k in range(1, labels + 1) for n in lengths
    ]
    if not parts:
        return "cast(array() as array<string>)"
    ordered = (
        "case when length(x) > length(y) then -1 when length(x) < length(y) then 1 "
        "when instr(x, '/') > instr(y, '/') then -1 when instr(x, '/') < instr(y, '/') then 1 else 0 end"
    )
    return f"array_sort(array_compact(array({', '.join(parts)})), (x, y) -> {ordered})"


@dataclass(frozen=True)
class Bloom:
    """Filter words and how keys are hashed into them."""

    level: int
    bits: int
    hashes: int
    words: tuple[int, ...]

    def place(self, key: str, number: int) -> str:
        return f"pmod(xxhash64({key}, {self.level}, {number}), {self.bits}L)"

    def sql(self, key: str) -> str:
        words = "array(" + ", ".join(f"{w}L" if w > -(1 << 63) else "shiftleft(1L, 63)" for w in self.words) + ")"
        return "(" + " and ".join(
            f"bit_get(element_at({words}, cast({self.place(key, n)} div 64 as int) + 1), cast({self.place(key, n)} % 64 as int)) = 1"
            for n in range(self.hashes)
        ) + ")"


def bloom(keys: DataFrame, level: int, rate: float) -> Bloom:
    """A filter over the column ``key``; its words are the only thing collected."""
    count = max(1, keys.count())
    hashes = max(1, round(-math.log2(rate)))
    bits = 64 * max(1, math.ceil(1.4427 * -math.log2(rate) * count / 64))
    empty = Bloom(level, bits, hashes, ())
    places = keys.select(F.explode(F.expr("array(" + ", ".join(empty.place("key", n) for n in range(hashes)) + ")")).alias("place"))
    words = [0] * (bits // 64)
    for row in places.groupBy(F.expr("place div 64").alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(place % 64 as int)))").alias("held")).collect():
        words[row["word"]] = row["held"]
    return Bloom(level, bits, hashes, tuple(words))


def cascade(universe: DataFrame, listed: list[str], most: int = 64) -> list[Bloom]:
    """Levels that answer exactly, for every ``key`` of the universe, whether it is listed."""
    if len(listed) > MAX_RULES:
        raise ValueError(f"{len(listed)} rules; {MAX_RULES} at most")
    if not listed:
        return []
    names = F.broadcast(universe.sparkSession.createDataFrame([(x,) for x in listed], "key string"))
    held, rest = universe.join(names, "key", "left_semi"), universe.join(names, "key", "left_anti")
    levels: list[Bloom] = []
    while len(levels) < most:
        if held.isEmpty():
            return levels
        level = bloom(held, len(levels), RATE if levels else FIRST_RATE)
        levels.append(level)
        held, rest = rest.where(level.sql("key")), held
    raise RuntimeError("the cascade did not end")


def listed_sql(levels: list[Bloom], key: str) -> str:
    """SQL for membership: the first level that lacks the key decides."""
    answer = "true" if len(levels) % 2 else "false"
    for number in range(len(levels) - 1, -1, -1):
        answer = f"if({levels[number].sql(key)}, {answer}, {'false' if number % 2 == 0 else 'true'})"
    return answer


def judge_urls(pages: DataFrame, rules: dict[str, str] | None = None) -> DataFrame:
    """Host, path, rule and verdict of each page (page_id, url)."""
    rules = RULES if rules is None else rules
    keyed = with_parts(pages.select("page_id", "url")).withColumn("tm_keys", F.expr(keys_sql(rules)))
    universe = stored(keyed.select(F.explode("tm_keys").alias("key")).distinct())
    blocked, allowed = (cascade(universe, [r for r, v in rules.items() if v == verdict]) for verdict in ("block", "allow"))
    found = keyed.withColumn("tm_hits", F.expr(
        f"filter(transform(tm_keys, k -> struct(k as key, case when {listed_sql(blocked, 'k')} then 'block' "
        f"when {listed_sql(allowed, 'k')} then 'allow' end as verdict)), h -> h.verdict is not null)"
    ))
    return found.select(
        "page_id", "host", "path", F.expr("get(tm_hits, 0).key").alias("rule"),
        F.expr("coalesce(get(tm_hits, 0).verdict, 'allow')").alias("verdict"),
    )
