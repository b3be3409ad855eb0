"""Operator 7 [native]: URL pattern rules indexed by their rarest literal token.

Every rule is a regular expression on ``host + path`` with the literal tokens that any
match must hold.  Token counts over all URLs choose each rule's rarest token; a URL's
tokens look up candidate rules in that index and only those run their expression.

Null URLs and URLs without ``://`` have empty host and path and match nothing (verdict
``default``).  Repeated rows are judged alike; ties of equally long rules go to the
smaller pattern.  An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The index is one literal map in the plan; longer lists must be split over several calls.
MAX_RULES = 5000


@dataclass(frozen=True)
class Rule:
    name: str
    pattern: str  # Java regular expression, searched in host + path
    tokens: tuple[str, ...]  # [A-Za-z0-9]+ runs that are whole tokens of every match
    verdict: str
    rank: int  # the highest matching rank wins
    listed: bool = False  # a host/path rule, reported in the rule column


def host_rule(host: str, path: str, verdict: str) -> Rule:
    """A host with its subdomains whose path starts with ``path``; longer rules rank higher."""
    full = re.findall(r"[A-Za-z0-9]+", host)
    # The last token of the path may go on in the URL unless something ends it.
    full += re.findall(r"(?<=[^A-Za-z0-9])[A-Za-z0-9]+(?=[^A-Za-z0-9])", path)
    esc = lambda s: re.sub(r"([^A-Za-z0-9/])", r"\\\1", s)
    return Rule(host + path, rf"^(?:[^/]*\.)?{esc(host)}{esc(path)}", tuple(full), verdict, 1000 + len(host + path), True)


# The rules of the contract (host, path, verdict).
HOST_RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
# Pattern rules of the method (name, pattern, tokens, verdict).
PATTERN_RULES = (
    ("spam host", r"^(?:[^/]*\.)?spam-[a-z0-9-]+\.", ("spam",), "block"),
    ("casino host", r"^(?:[^/]*[.-])?casino[.-]", ("casino",), "block"),
    ("adult host", r"^(?:[^/]*[.-])?(?:adult|xxx)[.-]", (), "block"),
    ("ad server", r"^ads?\.", (), "block"),
    ("tracker path", r"/track(?:er|ing)?/", (), "block"),
    ("login page", r"/login(?:/|\.|$)", ("login",), "block"),
)


def default_rules() -> list[Rule]:
    return [host_rule(*r) for r in HOST_RULES] + [Rule(n, p, t, v, 0) for n, p, t, v in PATTERN_RULES]


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    u = F.coalesce(url, F.lit(""))
    at = F.locate("://", u)
    rest = F.when(at > 0, u.substr(at + 3, F.char_length(u))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), upper, lower)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return host, path


def _tokens(host: Column, path: Column) -> Column:
    return F.array_distinct(F.array_remove(F.split(F.concat(host, path), "[^A-Za-z0-9]+"), ""))


def judge_urls(pages: DataFrame, rules: list[Rule] | None = None, key: str = "page_id", url: str = "url",
               default: str = "allow") -> DataFrame:
    """key, host, path, rule (host/path rule or null), pattern (deciding rule or null), verdict."""
    rules = default_rules() if rules is None else rules
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules in one call")
    host, path = split_url(F.col(url))
    rows = pages.select(F.col(key), host.alias("host"), path.alias("path")).withColumn("_t", _tokens(F.col("host"), F.col("path")))
    literal = sorted({t for r in rules for t in r.tokens})
    # Corpus counts of the rules' own literals only: one row a literal comes back.
    counts = {}
    if literal:
        hits = rows.select(F.explode(F.array_intersect("_t", F.array(*map(F.lit, literal)))).alias("t"))
        counts = {r["t"]: r["n"] for r in hits.groupBy("t").agg(F.count(F.lit(1)).alias("n")).collect()}
    index: dict[str, list[Rule]] = {}
    for r in rules:  # rules without a literal token are candidates for all
        rare = min(r.tokens, key=lambda t: (counts.get(t, 0), t)) if r.tokens else ""
        index.setdefault(rare, []).append(r)

    def packed(rs: list[Rule]) -> Column:
        return F.array(*[F.struct(F.lit(r.rank).alias("rank"), F.lit(r.name).alias("name"), F.lit(r.pattern).alias("p"),
                                  F.lit(r.verdict).alias("verdict"), F.lit(r.listed).alias("listed")) for r in rs])

    empty = "cast(array() as array<struct<rank:int,name:string,p:string,verdict:string,listed:boolean>>)"
    table = F.create_map(*[x for t, rs in index.items() for x in (F.lit(t), packed(rs))]) if index else None
    address = F.concat(F.col("host"), F.col("path"))
    if table is None:
        found = F.expr(empty)
    else:
        probe = F.array_union(F.array(F.lit("")), F.array_intersect(F.col("_t"), F.array(*map(F.lit, index))))
        fetched = F.flatten(F.transform(probe, lambda t: F.coalesce(F.element_at(table, t), F.expr(empty))))
        found = F.filter(fetched, lambda r: F.call_function("rlike", address, r["p"]) & (address != ""))
    best = F.get(F.sort_array(F.transform(found, lambda r: F.struct((-r["rank"]).alias("o"), r["name"].alias("name"),
                 r["verdict"].alias("verdict"), r["listed"].alias("listed")))), F.lit(0))
    rows = rows.withColumn("_best", best)
    return rows.select(key, "host", "path", F.when(F.col("_best.listed"), F.col("_best.name")).alias("rule"),
                       F.col("_best.name").alias("pattern"), F.coalesce(F.col("_best.verdict"), F.lit(default)).alias("verdict"))
