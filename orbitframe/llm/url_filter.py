"""URL filters: pattern rules indexed by their rarest literal token.

Each rule has literal tokens (runs of ASCII letters and digits that any URL it fits must hold).
The rule is filed under the one of them that the fewest URLs hold.  A URL's distinct tokens fetch
candidate rules from that index, and only those candidates run their regular expressions.  Rules
without a token can't be filed; every URL runs them.

Everything is DataFrame operations.  Defined results: a null URL, one without ``://`` and an empty
one have an empty host and path and fit no rule; a repeated row is judged for itself, a row without
an id too; a long URL is judged whole; of rules that fit equally well the smallest name wins; an
empty table gives an empty one; other columns of the input, whatever their names, are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Up to this many bytes of rules the index is broadcast; a larger one is joined by shuffle.
BROADCAST_BYTES = 8 << 20


@dataclass(frozen=True)
class Rule:
    """A regular expression over host and path, the tokens it implies, and what it decides.

    Among fitting rules the highest tier wins, then the longest name, then the smallest name.
    """

    name: str
    action: str
    pattern: str
    tokens: tuple[str, ...]
    tier: int = 0


def place_rule(action: str, place: str) -> Rule:
    """A rule for ``host/path``: its host and all subdomains, and paths that start with its path."""
    host, _, rest = place.partition("/")
    path = "/" + rest
    ends = re.findall(r"[A-Za-z0-9]+(?=[^A-Za-z0-9])", path)  # a last, cut token may go on in the URL
    return Rule(place, action, rf"^(?:[^/]*\.)?{re.escape(host)}{re.escape(path)}", (*re.findall("[A-Za-z0-9]+", host), *ends), 1)


def word_rule(action: str, label: str) -> Rule:
    """A rule for hosts in which one dot-separated label is just this."""
    return Rule(label, action, rf"^(?:[^/]*\.)?{re.escape(label)}(?:\.[^/]*)?(?:/|$)", tuple(re.findall("[A-Za-z0-9]+", label)))


def pattern_rule(action: str, text: str) -> Rule:
    """A rule ``host/path`` with ``*`` for any characters (in the host, for any but a slash).

    The host means its subdomains too, the path what starts with it; ``$`` at the end is the end.
    """
    host, slash, rest = text.partition("/")
    path = slash + rest
    ends = path.endswith("$")
    path = path.removesuffix("$")
    wild = lambda s, any_: any_.join(map(re.escape, s.split("*")))
    pattern = rf"^(?:[^/]*\.)?{wild(host.lower(), '[^/]*')}" + (wild(path, "(?s:.*)") + r"\z" * ends if path else r"(?:/|\z)")
    # a run counts as a token where what stands beside it in a URL is known: the host's ends, or another sign
    found = re.findall(r"(?<![A-Za-z0-9*])[A-Za-z0-9]+(?![A-Za-z0-9*])", host.lower())
    found += re.findall(r"(?<![A-Za-z0-9*])[A-Za-z0-9]+(?=[^A-Za-z0-9*])" + (r"|(?<![A-Za-z0-9*])[A-Za-z0-9]+$" if ends else ""), path)
    return Rule(text, action, pattern, tuple(dict.fromkeys(found)))


def rules_of(table: DataFrame) -> list[Rule]:
    """Rules of a table with the columns action, pattern and kind (place, word or pattern): a list that its user keeps."""
    make = {"place": place_rule, "word": word_rule, "pattern": pattern_rule}
    return [make[r.kind](r.action, r.pattern) for r in table.select("action", "pattern", "kind").distinct().orderBy("kind", "pattern", "action").collect()]


#: Words of hosts that advertise, gamble or sell; and paths of machinery and programs, on any host.
HOST_WORDS = ("ads", "adserver", "adult", "bet", "bets", "bonus", "casino", "escort", "jackpot", "lottery", "loans", "payday", "pharmacy", "pills", "poker", "porn", "replica", "slots", "spam", "tracker", "viagra", "xxx")
PATHS = ("*/wp-admin/", "*/wp-login.php", "*/cgi-bin/", "*/phpmyadmin/", "*/*.exe$", "*/*.apk$")


def default_rules() -> list[Rule]:
    """For each of HOST_WORDS the labels that are it, or hold it beside hyphens; and PATHS."""
    shapes = ("{}", "{}.*", "{}-*", "*-{}", "*-{}.*", "*-{}-*")
    return [pattern_rule("block", s.format(w)) for w in HOST_WORDS for s in shapes] + [pattern_rule("block", p) for p in PATHS]


def host_and_path(url: Column) -> tuple[Column, Column]:
    after = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3))
    host = F.regexp_extract(after, r"^([^/?#]*)", 1)
    path = F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit("")), F.coalesce(path, F.lit(""))


def tokens_of(text: Column) -> Column:
    return F.array_distinct(F.split(text, "[^A-Za-z0-9]+"))


def rule_index(urls: DataFrame, rules: list[Rule], ranks: dict[Rule, int] | None = None) -> DataFrame:
    """Each rule with the one of its tokens that the fewest of the URLs (column subject) hold."""
    spark = urls.sparkSession
    rows = [(ranks[r] if ranks else i, r.name, r.action, r.pattern, r.tier, len(r.name), list(r.tokens)) for i, r in enumerate(rules)]
    table = spark.createDataFrame(rows, "n int, rule string, action string, pattern string, tier int, size int, tokens array<string>")
    own = table.select("n", F.explode("tokens").alias("token"))
    wanted = own.select("token").distinct()
    count = urls.select(F.explode(tokens_of(F.col("subject"))).alias("token")).join(small(wanted, rules), "token").groupBy("token").count()
    best = own.join(count, "token", "left").groupBy("n").agg(F.min(F.struct(F.coalesce("count", F.lit(0)), "token"))["token"].alias("token"))
    return table.drop("tokens").join(best, "n")


def small(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Broadcast df if what it is made from, the rules, is small."""
    size = sum(len(r.name) + len(r.pattern) + sum(map(len, r.tokens)) + 64 for r in rules)
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def judge(pages: DataFrame, rules: list[Rule], default: str = "allow", key: str = "page_id", url: str = "url") -> DataFrame:
    """key, host, path, rule, tier and verdict for each row of pages."""
    if not rules:
        raise ValueError("there must be rules")
    ranks = {r: i for i, r in enumerate(sorted(rules, key=lambda r: (r.name, r.action)))}
    filed, loose = [r for r in rules if r.tokens], [r for r in rules if not r.tokens]
    rows = pages.select(F.col(key).alias("__key"), F.col(url).cast("string").alias("__url"))
    host, path = host_and_path(F.col("__url"))
    rows = rows.select("__key", host.alias("host"), path.alias("path")).withColumn("subject", F.concat("host", "path"))
    # a row's own number keeps repeated rows apart
    named = rows.withColumn("row", F.monotonically_increasing_id())

    def fitting(subject: Column, c) -> Column:
        """What a max takes the best of: tier, length, then the smallest name, by its order among the rules."""
        fits = F.when(c("pattern").isNotNull(), F.regexp_like(subject, c("pattern")))
        return F.when(fits, F.struct(c("tier").alias("tier"), c("size").alias("size"), (-c("n")).alias("order"), c("rule").alias("rule"), c("action").alias("action")))

    best = F.lit(None).cast("struct<tier:int,size:int,order:int,rule:string,action:string>")
    for r in loose:
        own = {"pattern": r.pattern, "tier": r.tier, "size": len(r.name), "n": ranks[r], "rule": r.name, "action": r.action}
        best = F.greatest(best, fitting(F.col("subject"), lambda c, own=own: F.lit(own[c])))
    named = named.withColumn("loose", best)
    if filed:
        index = rule_index(rows, filed, ranks)
        each = named.withColumn("token", F.explode(tokens_of(F.col("subject"))))
        named = each.join(small(index, filed), "token", "left").withColumn("filed", fitting(F.col("subject"), F.col))
        named = named.groupBy("row", "__key", "host", "path", "loose").agg(F.max("filed").alias("filed"))
        best = F.greatest("loose", "filed")
    else:
        best = F.col("loose")
    out = named.withColumn("best", best)
    return out.select(
        F.col("__key").alias(key), "host", "path", F.col("best.rule").alias("rule"), F.col("best.tier").alias("tier"),
        F.coalesce("best.action", F.lit(default)).alias("verdict"),
    )
