"""URL filters: pattern rules indexed by their rarest literal token.

A rule is written as a filter: ``||`` anchors it at the host or one of its parent domains,
``^`` is a separator or the end, ``*`` is anything, all else is literal.  A literal token is a run of
letters and digits that the filter bounds on both sides, so every URL that the rule fits has
it as a token of its own.  Each rule is indexed under the one of its tokens that the corpus
has least often; the tokens of a URL fetch the candidate rules, and only those run.
"""

from __future__ import annotations

import re
from collections import defaultdict
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricetrail.llm.common import stored

RESULT = "host string, path string, rule string, verdict string, filter string, n_tried int"
_TOKEN = re.compile("[a-z0-9]+")
_UPPER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


@dataclass(frozen=True)
class Rule:
    """``site`` rules are named by their text and outrank the others; of several the longest wins."""

    filter: str
    verdict: str
    site: str | None = None

    @property
    def pattern(self) -> str:
        anchored = self.filter.startswith("||")
        parts = {"*": ".*", "^": "(?:[^A-Za-z0-9_.%-]|$)"}
        body = "".join(parts.get(c) or re.escape(c) for c in self.filter[2 * anchored :])
        return ("^(?:[^/]*[.])?" if anchored else "") + body

    @property
    def tokens(self) -> list[str]:
        """Literal tokens that are bounded on both sides, lower-cased."""
        anchored = self.filter.startswith("||")
        body = self.filter[2 * anchored :].lower()
        found = []
        for m in _TOKEN.finditer(body):
            before = body[m.start() - 1] if m.start() else ("." if anchored else "*")
            after = body[m.end()] if m.end() < len(body) else "*"
            if before != "*" and after != "*" and before.isascii() and after.isascii():
                found.append(m.group())
        return found


def site_rule(verdict: str, text: str) -> Rule:
    """A rule on a host, its subdomains and the beginning of the path, such as ``org/``."""
    return Rule("||" + text, verdict, text)


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    if not url or "://" not in url:
        return "", ""
    rest = re.split("[?#]", url.split("://", 1)[1], maxsplit=1)[0]
    at = rest.find("/")
    host, path = (rest, "") if at < 0 else (rest[:at], rest[at:])
    return host.translate(_UPPER), path


def url_tokens(host: str, path: str) -> set[str]:
    return set(_TOKEN.findall(f"{host}{path}".lower()))


@dataclass
class RuleIndex:
    rules: list[Rule]
    counts: dict[str, int] = field(default_factory=dict)

    def __post_init__(self):
        self.by_token: dict[str, list[tuple[Rule, re.Pattern]]] = defaultdict(list)
        self.always: list[tuple[Rule, re.Pattern]] = []  # rules without a literal token
        for rule in self.rules:
            rarest = min(rule.tokens, key=lambda t: (self.counts.get(t, 0), -len(t), t), default=None)
            bucket = self.always if rarest is None else self.by_token[rarest]
            bucket.append((rule, re.compile(rule.pattern, re.DOTALL)))

    def judge(self, url: str | None) -> tuple:
        host, path = split_url(url)
        target = host + path
        tried = [*self.always]
        for token in url_tokens(host, path):
            tried += self.by_token.get(token, ())
        fits = [rule for rule, pattern in tried if pattern.search(target)]
        sites = sorted((r for r in fits if r.site is not None), key=lambda r: (-len(r.site), r.site))
        others = sorted((r for r in fits if r.site is None), key=lambda r: (r.verdict, r.filter))
        first = (sites or others or [None])[0]
        return (
            host,
            path,
            sites[0].site if sites else None,
            first.verdict if first else "allow",
            others[0].filter if others else None,
            len(tried),
        )


def token_counts(urls: DataFrame, rules: list[Rule]) -> dict[str, int]:
    """How many rows of ``urls`` (url) have each literal token of the rules; one row per rule token comes back."""
    wanted = sorted({t for rule in rules for t in rule.tokens})
    if not wanted:
        return {}
    tokens = urls.sparkSession.createDataFrame([(t,) for t in wanted], "token string")
    tokens = stored(tokens, "rule-tokens")
    target = F.regexp_extract(F.coalesce("url", F.lit("")), r"(?s)://([^?#]*)", 1)
    own = F.array_distinct(F.regexp_extract_all(F.lower(target), F.lit("[a-z0-9]+"), F.lit(0)))
    seen = urls.select(F.explode(own).alias("token")).join(tokens, "token")
    return {r["token"]: r["n"] for r in seen.groupBy("token").agg(F.count("*").alias("n")).collect()}


def verdicts(url: Column, index: RuleIndex) -> Column:
    @F.pandas_udf(RESULT)
    def judge(urls: pd.Series) -> pd.DataFrame:
        names = [f.split()[0] for f in RESULT.split(", ")]
        return pd.DataFrame([index.judge(u) for u in urls], columns=names)

    return judge(url)


def filter_urls(pages: DataFrame, rules: list[Rule], key: str = "page_id") -> DataFrame:
    """One row per row of ``pages`` (key, url): host, path, rule, verdict, filter and n_tried.

    ``rule`` is the text of the longest site rule that fits, or null; ``filter`` is the first
    other rule that fits, exceptions before blocks, or null.  The verdict is the site rule's, else
    the filter's, else ``allow``.  Null urls and urls without ``://`` have an empty host and
    path.  Repeated rows are judged each; further columns are ignored.  The rule list is
    an argument and travels with the tasks.
    """
    index = RuleIndex(rules, token_counts(pages.select("url"), rules))
    judged = pages.select(key, verdicts(F.col("url"), index).alias("found"))
    return judged.select(key, "found.*")
