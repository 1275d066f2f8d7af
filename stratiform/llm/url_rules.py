"""URL filters (operator 5), DataFrame functions only.

Two kinds of rules: host/path rules (`example.com/en/`, allow or block; the longest that fits wins) and patterns
(filter lines, see `parse_rules`, or regular expressions with a literal part) that decide the other URLs; an exception beats a block. Every rule is indexed by one literal token, the one that
is rarest among the URLs' tokens: a frequency of the rules' own tokens over the whole table is counted first (one partially
aggregated row per token). A URL's distinct tokens look up their candidate rules, and only those run their regular expression. Tokens of host/path rules are
whole runs of a-z and 0-9; so are runs of a pattern that literals or anchors enclose, however short (`||t.co^`, `/ad/`). Other literals of a pattern may lie inside a longer run, so their tokens are tri-grams,
and a URL's are those of its runs. A pattern without either is tried on every URL.

Up to INLINE rules the index is a literal map inside the projection, and judging is a map over rows with no shuffle. More rules
go through `judge_joined`: tokens are exploded and joined with the index (Spark broadcasts it only below its own size
threshold, otherwise both sides are shuffled by token and a hot token is split by the adaptive join), and candidates that fit are
reduced per URL by a partially aggregated maximum.

Defined cases: a null URL or one without :// has an empty host and path and fits no rule; the pattern verdict is then `allow`.
Repeated rows give a row each. Extra columns stay. Host matching ignores the case of A-Z, paths are compared as they are.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
INLINE = 500
_TOKEN = "[a-z0-9]+"
#: Before a tri-gram, so that it is no whole run.
_PART = "*"


@dataclass(frozen=True)
class Rule:
    """A rule's text, its verdict, its regular expression over `host + path` with the host lower-cased, its literal tokens (none: it is tried on every URL)."""

    name: str
    verdict: str
    regex: str
    tokens: tuple[str, ...]
    host_rule: bool


def _quoted(s: str) -> str:
    return re.sub(r"([.^$*+?()\[\]{}|\\])", r"\\\1", s)


def host_rule(name: str, verdict: str) -> Rule:
    """`com/`, `example.com/en/`: the host and all its subdomains, paths that start with the rest."""
    host, path = name.split("/", 1)
    whole = re.findall(_TOKEN, host.lower()) + re.findall(f"{_TOKEN}(?=[^a-z0-9])", path.lower())  # the last one may go on in a URL
    return Rule(name, verdict, f"^([^/]*\\.)?{_quoted(host)}/{_quoted(path)}", tuple(whole), True)


def pattern_rule(regex: str, tokens: Iterable[str] = (), verdict: str = "block", whole: Iterable[str] = ()) -> Rule:
    """A regular expression. Every match contains all the tokens (a-z and 0-9), inside longer runs too, and all of `whole` as whole runs of any length.

    Without a whole run and a token of three characters it can't be indexed: then it is tried on every URL.
    """
    parts = {_PART + t[i : i + 3] for t in tokens for i in range(len(t) - 2)}
    return Rule(regex, verdict, regex, tuple(sorted(parts | set(whole))), False)


#: Options of a line that say nothing more for the URLs of pages.
_NO_LIMIT = {"document", "doc", "all"}


def _line_rule(line: str) -> Rule:
    allow, body = line.startswith("@@"), line.removeprefix("@@")
    start, body = ("^([^/]*[.])?", body[2:]) if body.startswith("||") else ("^", body[1:]) if body.startswith("|") else ("", body)
    end, body = ("$", body[:-1]) if body.endswith("|") else ("", body)
    regex = start + "".join(".*" if c == "*" else "([^A-Za-z0-9_.%-]|$)" if c == "^" else _quoted(c) for c in body) + end
    whole, parts = [], []
    for m in re.finditer(_TOKEN, body.lower()):
        left = body[m.start() - 1] if m.start() else "^" if start else "*"
        right = body[m.end()] if m.end() < len(body) else "^" if end else "*"
        # a literal or an anchor on both sides ends a run; any characters, and letters that only lower-casing made plain, may go on
        closed = all(c != "*" and c.isascii() for c in (left, right))
        (whole if closed else parts).append(m[0])
    return Rule(line, "allow" if allow else "block", regex, pattern_rule(regex, parts, whole=whole).tokens, False)


def parse_rules(lines: str | Iterable[str], skipped: dict[str, str] | None = None) -> list[Rule]:
    """Rules from filter lines, one in a line, that are looked for in the host and path of a URL:

    `||` at the beginning: where the host or one of its labels begins; `|` at the beginning or end: the beginning or end of host and path;
    `*`: any characters; `^`: one that is no letter, digit, `_`, `.`, `%` or `-`, or the end; `@@` before a rule: an exception.
    Anything else stands for itself. Blank lines and those that begin with `!`, `#` or `[` are comments. Options ($...) that limit nothing here are
    taken off. Rules about elements of a page (`##` and its kin) and lines whose options limit them to requests that a page's URL doesn't tell
    (`$third-party`, `$script`) are no rules for URLs: they are left out, and told with the reason in `skipped`.
    """
    out = []
    for line in lines.splitlines() if isinstance(lines, str) else lines:
        line = line.strip()
        if re.search(r"#[@?$%]*#", line):
            why = "about elements of a page"
        elif not line or line[0] in "!#[":
            continue
        else:
            m = re.search(r"\$((?:~?[a-z0-9_-]+(?:=[^,$]*)?)(?:,~?[a-z0-9_-]+(?:=[^,$]*)?)*)$", line)
            limits = [o for o in m[1].split(",") if o not in _NO_LIMIT] if m else []
            why = f"limited by {', '.join(limits)}" if limits else ""
            if m and not limits:
                line = line[: m.start()]
        if why:
            if skipped is not None:
                skipped[line] = why
            continue
        out.append(_line_rule(line))
    return out


def read_rules(lines: DataFrame) -> list[Rule]:
    """Rules from a table of filter lines (value): a list that people keep, so it is small beside the URLs; it is collected."""
    return parse_rules(r["value"] for r in lines.select("value").filter("value is not null").collect())


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end; A-Z lower-cased; empty without ://."""
    rest = F.when(F.instr(url, "://") > 0, F.substring_index(_after(url), "/", 1)).otherwise("")
    host = F.substring_index(F.substring_index(rest, "?", 1), "#", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """From the first / after the host up to ?, # or the end; empty without ://."""
    rest = F.substring_index(F.substring_index(_after(url), "?", 1), "#", 1)
    slash = F.instr(rest, "/")
    path = F.when((F.instr(url, "://") > 0) & (slash > 0), F.substring(rest, slash, F.length(rest))).otherwise("")
    return F.coalesce(path, F.lit(""))


def _after(url: Column) -> Column:
    return F.substring(url, F.instr(url, "://") + 3, F.length(url))


def tokens_of(target: Column, parts: bool = True) -> Column:
    """The distinct runs of a-z and 0-9 of the lower-cased host and path, and the marked tri-grams of these runs."""
    low = F.translate(target, UPPER, LOWER)
    runs = F.regexp_extract_all(low, F.lit(f"({_TOKEN})"), 1)
    if parts:
        runs = F.concat(runs, F.transform(F.regexp_extract_all(low, F.lit("(?=([a-z0-9]{3}))"), 1), lambda t: F.concat(F.lit(_PART), t)))
    return F.array_distinct(runs)


def token_counts(urls: DataFrame, rules: list[Rule]) -> dict[str, int]:
    """In how many rows of `urls` (column target) each token of a rule occurs; at most one row per token is collected."""
    wanted = sorted({t for r in rules for t in r.tokens})
    known = F.filter(F.col("tokens"), lambda t: t.isin(wanted))
    rows = urls.select(F.explode(known).alias("token")).groupBy("token").count().collect()
    return {r["token"]: r["count"] for r in rows}


def index(rules: list[Rule], counts: dict[str, int]) -> dict[str, list[Rule]]:
    """Rules by their rarest token; ties to the longer token, then by the alphabet. Rules without a token are in none."""
    out: dict[str, list[Rule]] = {}
    for rule in rules:
        if not rule.tokens:
            continue
        token = min(rule.tokens, key=lambda t: (counts.get(t, 0), -len(t), t))
        out.setdefault(token, []).append(rule)
    return out


def _fields(rule: Rule) -> tuple[bool, int, str, str, str]:
    """In the order in which the greatest wins: host/path rules by length, then patterns, exceptions first."""
    return rule.host_rule, len(rule.name) if rule.host_rule else int(rule.verdict == "allow"), rule.name, rule.verdict, rule.regex


_NAMES = ("host_rule", "weight", "name", "verdict", "regex")
_FIT = "struct<host_rule:boolean,weight:int,name:string,verdict:string,regex:string>"


def _struct(rule: Rule) -> Column:
    return F.struct(*(F.lit(v).alias(n) for n, v in zip(_NAMES, _fields(rule))))


def prepared(pages: DataFrame, url: str, parts: bool = True) -> DataFrame:
    drop = ("host", "path", "rule", "verdict", "tokens", "target")
    df = pages.select([f"`{c}`" for c in pages.columns if c not in drop]).withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    df = df.withColumn("target", F.concat("host", "path"))
    return df.withColumn("tokens", tokens_of(F.col("target"), parts))


def judge(pages: DataFrame, rules: list[Rule], url: str = "url", inline: int = INLINE) -> DataFrame:
    """pages with host, path, rule (the winning host/path rule, else null) and verdict."""
    wanted = sorted({t for r in rules for t in r.tokens})
    df = prepared(pages, url, any(t.startswith(_PART) for t in wanted))
    if len(rules) <= inline and wanted:  # only tokens that some rule has are looked at
        df = df.withColumn("tokens", F.array_intersect("tokens", F.array(*map(F.lit, wanted))))
    counts = token_counts(df, rules)
    by_token = index(rules, counts)
    always = F.array(*(_struct(r) for r in rules if not r.tokens)) if any(not r.tokens for r in rules) else None
    if len(rules) > inline:
        df = judge_joined(df, by_token)
        candidates = F.array(F.col("fit")) if always is None else F.concat(F.array(F.col("fit")), _fitting(always))
        return _verdict(df.withColumn("fit", F.array_max(candidates)))
    lookup = F.create_map(*[x for t, found in sorted(by_token.items()) for x in (F.lit(t), F.array(*map(_struct, found)))]) if by_token else None
    found = F.flatten(F.filter(F.transform("tokens", lambda t: F.try_element_at(lookup, t)), lambda c: c.isNotNull())) if by_token else always
    candidates = F.concat(found, always) if by_token and always is not None else found
    return _verdict(df.withColumn("fit", F.array_max(_fitting(candidates)) if rules else F.lit(None).cast(_FIT)))


def _fitting(candidates: Column) -> Column:
    return F.filter(candidates, lambda c: F.call_function("rlike", F.col("target"), c["regex"]))


def judge_joined(df: DataFrame, by_token: dict[str, list[Rule]]) -> DataFrame:
    """The best rule (`fit`) for many rules: an exploded equi-join of tokens with the index."""
    spark = df.sparkSession
    rows = [(t, *_fields(r)) for t, found in by_token.items() for r in found]
    rules = spark.createDataFrame(rows, "token string, host_rule boolean, weight int, name string, verdict string, regex string")
    keyed = df.select("target", F.explode("tokens").alias("token")).distinct()
    met = keyed.join(rules, "token").filter(F.call_function("rlike", F.col("target"), F.col("regex")))
    return df.join(met.groupBy("target").agg(F.max(F.struct(*_NAMES)).alias("fit")), "target", "left")


def _verdict(df: DataFrame) -> DataFrame:
    rule = F.when(F.col("fit.host_rule"), F.col("fit.name"))
    return df.withColumns({"rule": rule, "verdict": F.coalesce("fit.verdict", F.lit("allow"))}).drop("tokens", "target", "fit")
