"""URL filter by a cascade of Bloom filters: exact membership without joining the pages with any list.

A first filter encodes the listed keys. Over the complete universe of keys that the corpus holds it has some false
positives; a second filter encodes those, a third the listed keys that the second takes for false positives by mistake, and
so on until a level makes no mistakes. For any key of the universe the first level that says no decides, so the answer is
exact. Everything is built from DataFrame functions; the filters reach the pages as scalar subqueries.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
import operator

from pyspark.sql import Column, DataFrame, functions as F

from staykit.sources.tables import Workspace

BITS_PER_KEY = 8
PROBES = 3
# A filter of one level never takes more than this many 64-bit words (64 MB); longer lists go into several cascades.
WORDS = 2**23


@dataclass(frozen=True)
class Rule:
    """``action`` for a host and its subdomains below a path prefix, written like ``example.net/en/``."""

    action: str
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path


def url_host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty for NULL or no ``://``."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def host_suffixes(host: Column) -> Column:
    """The host and its parent domains, longest first."""
    parts = F.split(host, r"\.")
    return F.transform(
        F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), ".")
    )


def rule_keys(host: Column, path: Column, path_lengths: list[int]) -> Column:
    """Every rule name that could fit the URL: each host suffix with each prefix of the path that is as long as some rule's
    path. The longest comes first, the longer host on ties."""
    keys = F.flatten(F.transform(
        host_suffixes(host),
        lambda suffix: F.array(*[
            F.struct(
                (-F.length(suffix) - n).alias("longest"), (-F.length(suffix)).alias("host_length"),
                F.concat(suffix, F.substring(path, 1, n)).alias("key"), (F.length(path) >= n).alias("fits"),
            )
            for n in path_lengths
        ]),
    ))
    fitting = F.array_sort(F.filter(keys, lambda k: k["fits"]))
    return F.transform(fitting, lambda k: k["key"])


@dataclass(frozen=True)
class Level:
    words: DataFrame  # one row, one array of 64-bit words
    size: int  # bits


def _probes(key: Column, size: int, level: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(100 * level + i)), F.lit(size)) for i in range(PROBES)]


def _filter_of(keys: DataFrame, count: int, level: int) -> Level:
    """The Bloom filter of a one-column table of keys."""
    words = max(1, -(-count * BITS_PER_KEY // 64))
    if words > WORDS:
        raise ValueError(f"{count} keys need {words} words; divide the list over several cascades")
    size = 64 * words
    bits = keys.select(F.explode(F.array(*_probes(F.col("key"), size, level))).alias("bit"))
    set_words = bits.groupBy(F.floor(F.col("bit") / 64).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(bit % 64 AS INT))")).alias("bits")
    )
    # The unset words come from a range, so that a word's place in the array is its number.
    empty = keys.sparkSession.range(words).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("bits"))
    dense = set_words.unionByName(empty).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    row = dense.agg(F.array_sort(F.collect_list(F.struct("word", "bits"))).alias("words"))
    return Level(row.select(F.col("words.bits").alias("words")), size)


def _passes(key: Column, words: Column, level: Level, number: int) -> Column:
    tests = [
        F.getbit(F.element_at(words, (F.floor(bit / 64) + 1).cast("int")), F.pmod(bit, F.lit(64))) == 1
        for bit in _probes(key, level.size, number)
    ]
    return reduce(operator.and_, tests)


@dataclass(frozen=True)
class Cascade:
    levels: list[Level]

    def with_filters(self, df: DataFrame) -> DataFrame:
        """The rows with the filters' words as columns of their own, which ``contains`` reads: scalar subqueries, each
        evaluated once for all rows. Drop ``filter_columns`` afterwards."""
        return df.withColumns({c: level.words.scalar() for c, level in zip(self.filter_columns, self.levels)})

    @property
    def filter_columns(self) -> list[str]:
        return [f"_filter{number}" for number in range(len(self.levels))]

    def contains(self, key: Column) -> Column:
        """Exact for every key of the universe the cascade was built over."""
        answer = F.lit(len(self.levels) % 2 == 1)
        for number in range(len(self.levels) - 1, -1, -1):
            answer = F.when(~_passes(key, F.col(self.filter_columns[number]), self.levels[number], number), F.lit(number % 2 == 1)).otherwise(answer)
        return answer


def build_cascade(universe: DataFrame, work: Workspace) -> Cascade:
    """A cascade over distinct keys with columns ``key`` and ``listed`` (boolean).

    An empty list gives a cascade without levels, which contains nothing. NULL keys are not part of a universe.
    """
    universe = universe.where(F.col("key").isNotNull())
    counts = universe.agg(F.count_if("listed"), F.count_if(~F.col("listed"))).first()
    inside, outside = (universe.where(F.col("listed")).select("key"), universe.where(~F.col("listed")).select("key"))
    inside_count, levels = counts[0], []
    while inside_count:
        number = len(levels)
        level = _filter_of(inside, inside_count, number)
        level = Level(work.store(level.words, f"level{number}"), level.size)
        levels.append(level)
        # What passes by mistake is what the next level must hold back.
        wrong = work.store(outside.where(_passes(F.col("key"), level.words.scalar(), level, number)), f"wrong{number}")
        inside, outside, inside_count = wrong, inside, wrong.count()
    return Cascade(levels)


def filter_urls(pages: DataFrame, rules: list[Rule], blocked_host: Column, work: Workspace, url: str = "url") -> DataFrame:
    """Each page with ``host``, ``path``, ``rule`` and ``verdict``, beside its own columns (which give way on equal names).

    The longest rule that fits decides. Without one, ``blocked_host``, a condition on the column ``host``, decides; it is
    evaluated once per distinct host to make the list, and the pages ask the cascade. NULL and malformed URLs have an empty
    host and path, fit no rule and are allowed unless the condition lists the empty host. Repeated pages get a row each.
    """
    names = [r.name for r in rules]
    if len(set(names)) < len(names):
        raise ValueError("two rules have the same host and path")
    lengths = sorted({len(r.path) for r in rules})
    own = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    parsed = pages.select(*own, url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path"))
    rule_key = lambda action, key: F.concat(F.lit(f"{action} "), key)
    host_key = F.concat(F.lit("host "), F.col("host"))

    candidates = rule_keys(F.col("host"), F.col("path"), lengths) if rules else F.array().cast("array<string>")
    # Distinct before anything else: one very common host or path is a single row of each task's output.
    places = parsed.select("host", candidates.alias("candidates")).distinct()
    actions = sorted({r.action for r in rules})
    of_rules = places.select(F.explode(F.flatten(F.transform(
        "candidates", lambda k: F.array(*[rule_key(a, k) for a in actions]) if actions else F.array().cast("array<string>")
    ))).alias("key")).distinct()
    listed_names = [f"{r.action} {r.name}" for r in rules]
    universe = of_rules.select("key", F.col("key").isin(listed_names).alias("listed")).unionByName(
        places.select("host").distinct().select(host_key.alias("key"), F.coalesce(blocked_host, F.lit(False)).alias("listed"))
    )
    cascade = build_cascade(work.store(universe, "universe"), work)

    listed = lambda action, name: cascade.contains(rule_key(action, name))
    any_listed = lambda name: reduce(operator.or_, [listed(a, name) for a in actions], F.lit(False))
    first = F.get(F.filter(candidates, any_listed), F.lit(0)) if rules else F.lit(None).cast("string")
    judged = cascade.with_filters(parsed).withColumn("rule", first)
    of_rule = F.coalesce(*[F.when(listed(a, F.col("rule")), F.lit(a)) for a in actions], F.lit(None).cast("string"))
    by_list = F.when(cascade.contains(host_key), F.lit("block")).otherwise(F.lit("allow"))
    verdict = F.when(F.col("rule").isNotNull(), of_rule).otherwise(by_list)
    return judged.withColumn("verdict", verdict).drop(*cascade.filter_columns)
