"""URL verdicts by pattern rules that are indexed by their rarest literal token.

A rule's pattern can only match a URL that has all the words which the pattern spells out
whole; these are read from the pattern itself. Each rule is filed under the one of its words
that the fewest URLs hold, in any case. The words of a URL fetch its candidate rules, and only
those run their regular expressions.

Everything is DataFrame operations. A URL is judged once however many rows hold it, and
rows are matched with verdicts by a join that adaptive execution can split.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TOKEN = "[A-Za-z0-9]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# In a pattern that is being read: where a word must end, and where anything may stand.
_EDGE, _ANY = "\x01", "\x02"
_TIMES = r"(?:[?*+]|\{[0-9]+(?:,[0-9]*)?\})[?+]?"
# Groups in groups that are read; a pattern with more has no words.
_DEPTH = 6


@dataclass(frozen=True)
class Rule:
    """`pattern` runs on the host and path, which it may match anywhere. Rules of a higher
    `level` go before others, then longer names, then smaller ones. A rule that is not `named`
    decides without being reported."""

    name: str
    verdict: str
    pattern: str
    level: int = 1
    named: bool = True


def place_rule(verdict: str, host: str, path: str) -> Rule:
    """A rule for a host with all its subdomains, and paths with a given start."""
    return Rule(host + path, verdict, rf"^(?:[^/]*\.)?{re.escape(host)}{re.escape(path)}")


def text_rule(verdict: str, words: str) -> Rule:
    """A rule for words that stand whole and in a row, in any case, anywhere in host or path."""
    return Rule(words, verdict, rf"(?i)(?:^|[^A-Za-z0-9]){re.escape(words)}(?:$|[^A-Za-z0-9])", level=0, named=False)


def glob_rule(verdict: str, glob: str) -> Rule:
    """A rule for whole hosts with paths, in any case, in which `*` stands for any characters."""
    return Rule(glob, verdict, "(?is)^" + ".*".join(map(re.escape, glob.split("*"))) + "$", level=0, named=False)


# The method's own rules, for URLs that no place rule fits. Words of spam,
# malware, gambling and advertising, and the names that hosts and files of such sites bear.
GENERAL = (
    *(
        text_rule("block", words)
        for words in (
            "adserver", "adservice", "doubleclick", "phishing", "malware", "spyware", "xxx", "porn", "casino", "betting",
            "viagra", "cialis", "payday-loans", "keygen", "warez",
        )
    ),
    *(
        glob_rule("block", glob)
        for glob in ("ads.*/*", "*.ads.*/*", "ads-*.*/*", "*.ads-*.*/*", "*/ads/*.js", "*/banner/*.swf", "*/popunder/*")
    ),
)


def lower(text: Column) -> Column:
    """A-Z lower-cased, all else as it is."""
    return F.translate(text, _UPPER, _LOWER)


def literal_words(pattern: Column) -> Column:
    """The words that every match of a regular expression holds whole, lower-cased.

    A word counts if the pattern has it outside of groups, classes and repetitions, between
    ends that no match can go past. What is not understood takes words away, never adds any:
    the rest of its neighbours, or all words of the pattern.
    """

    def put(text: Column, what: str, by: str) -> Column:
        return F.regexp_replace(text, F.lit(what), F.lit(by))

    odd = F.rlike(pattern, F.lit(r"\\[QEcNxu0GAzZk\\]|\(\?[a-z-]*[xdumU]|[\x01\x02]"))
    text = put(pattern, r"^\(\?[is]+\)", "")
    text = put(text, r"\\[pP](?:\{[^}]*\}|[A-Z])", _ANY)
    text = put(text, r"\\b|\\[^A-Za-z0-9]", _EDGE)
    text = put(text, r"\\[A-Za-z0-9]", _ANY)
    # Classes: of all that ends a word, of signs alone, and others, innermost first.
    text = put(text, r"\[(?:\^A-Za-z0-9|[^\^\[\]A-Za-z0-9&\x02-][^\[\]A-Za-z0-9&\x02-]*)\]", _EDGE)
    for _ in range(2):
        text = put(text, r"\[[^\[\]]*\]", _ANY)
    ends = rf"(?:[\^$]\|{_EDGE}|{_EDGE}\|[\^$])"
    text = put(text, rf"\((?:\?:)?{ends}\)(?!{_TIMES})", _EDGE)
    text = put(text, rf"^\^\((?:\?:)?[^()|]*{_EDGE}\)\?(?![?+])", _EDGE)
    text = put(text, rf"{_EDGE}\+[?+]?", _EDGE)
    for _ in range(_DEPTH):
        text = put(text, r"\([^()]*\)", _ANY)
    text = put(text, rf"(?s).{_TIMES}", _ANY)
    text = put(text, r"\.", _ANY)
    text = put(text, r"[\^$]", _EDGE)
    words = F.regexp_extract_all(text, F.lit(rf"(?<=[^A-Za-z0-9{_ANY}]){TOKEN}(?=[^A-Za-z0-9{_ANY}])"), F.lit(0))
    clear = ~odd & ~F.rlike(text, F.lit(r"[|()\[\]]"))
    return F.when(clear, F.array_distinct(F.transform(words, lower))).otherwise(F.expr("CAST(array() AS array<string>)"))


def host_of(url: Column) -> Column:
    """From the first `://` to the next `/`, `?` or `#`, A-Z lower-cased; else empty."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)://(.*)$", 1)
    return lower(F.regexp_extract(rest, r"^[^/?#]*", 0))


def path_of(url: Column) -> Column:
    """From the end of the host to the next `?` or `#`; else empty."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)://(.*)$", 1)
    return F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_table(spark: SparkSession, rules: Iterable[Rule]) -> DataFrame:
    """The rules as a table: number, name, verdict, pattern, level, named."""
    rows = [
        F.struct(
            F.lit(number).alias("number"), F.lit(rule.name).alias("name"), F.lit(rule.verdict).alias("verdict"),
            F.lit(rule.pattern).alias("pattern"), F.lit(rule.level).alias("level"), F.lit(rule.named).alias("named"),
        )
        for number, rule in enumerate(rules)
    ]
    schema = "number int, name string, verdict string, pattern string, level int, named boolean"
    listed = F.array(*rows).cast(f"array<struct<{schema.replace(' ', ':').replace(',:', ',')}>>")
    return spark.range(1).select(F.inline(listed))


def candidates(places: DataFrame, rules: DataFrame) -> DataFrame:
    """Each `place`, a host and path, with the rules that its words fetch: those whose rarest
    word it holds, and those whose pattern has no word, which are filed under the empty one."""
    words = F.array_distinct(F.concat(F.array(F.lit("")), F.regexp_extract_all(lower(F.col("place")), F.lit(TOKEN), F.lit(0))))
    tokens = places.select("place", F.explode(words).alias("token"))

    spelled = literal_words(F.col("pattern"))
    spelled = rules.select("number", F.explode(F.when(F.size(spelled) > 0, spelled).otherwise(F.array(F.lit("")))).alias("token"))
    known = spelled.select("token").distinct()
    spread = tokens.join(known, "token").groupBy("token").agg(F.count(F.lit(1)).alias("places"))
    rarity = F.struct(F.coalesce("places", F.lit(0)), "token")
    filed = spelled.join(spread, "token", "left").groupBy("number").agg(F.min_by("token", rarity).alias("token"))
    return tokens.join(rules.join(filed, "number"), "token").drop("token")


def judge_urls(pages: DataFrame, rules: Iterable[Rule] | DataFrame, default: str = "allow", url: str = "url", key: str = "page_id") -> DataFrame:
    """Every page's key with host, path, rule and verdict.

    The verdict is that of the first matching rule, else `default`; `rule` is null where no
    named rule matches. A null URL, or one without `://`, has empty host and path and gets
    the default. Null keys and repeated rows are judged like any others; other columns are
    ignored. Without rules every URL gets the default. An empty table gives an empty result.

    Rules may be many, and then come as a table like that of `rule_table`, its numbers unique.
    What is broadcast is up to Spark's size checks.
    """
    spark = pages.sparkSession
    table = rules if isinstance(rules, DataFrame) else rule_table(spark, rules)

    judged = pages.select(F.col(key).alias("key"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    judged = judged.withColumn("place", F.concat("host", "path"))
    hits = candidates(judged.select("place").distinct(), table).filter(F.regexp_like("place", F.col("pattern")))
    rank = F.struct(-F.col("level"), -F.length("name"), "name", "verdict")
    found = hits.groupBy("place").agg(F.min_by(F.struct("name", "verdict", "named"), rank).alias("first"))
    return judged.join(found, "place", "left").select(
        F.col("key").alias(key),
        "host",
        "path",
        F.when(F.col("first.named"), F.col("first.name")).alias("rule"),
        F.coalesce("first.verdict", F.lit(default)).alias("verdict"),
    )
