r"""URL filter: host rules, and pattern rules indexed by their rarest literal token.

Host rules name a host suffix and a path prefix; the longest that fits decides.
Where none fits, pattern rules do. A URL's tokens are its runs of [a-z0-9_], and
these without the digits at their end. Of each pattern rule, sets of tokens are
known of which every match holds at least one: a token that it must hold whole,
the stem before digits, or the branches of an alternative. The rule is filed under
the set that the fewest URLs of the corpus contain, at each of its tokens. A URL's
tokens fetch the rules filed under them, and only those rules run their regular
expression. A rule without such a set (none of those shipped) is tried on every
URL.

Scale: only the url column is read. Token counts touch rule tokens alone and
are one row a token. The index is at most INLINE_RULES rules inside the plan,
so judging is one scan with no shuffle; larger rule sets are joined by token.

Defined cases: a null url, or one without "://", has an empty host and path and
matches no host rule; patterns see a null url as the empty string; repeated
rows are judged each; an empty table gives no rows.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

#: Pattern rules that a plan holds; beyond that they are joined.
INLINE_RULES = 1000


@dataclass(frozen=True)
class HostRule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class PatternRule:
    """regex is tried on the URL, A-Z lower-cased."""

    name: str
    regex: str
    verdict: str = "block"


HOST_RULES = (
    HostRule("net", "/", "block"),
    HostRule("example.net", "/en/", "allow"),
    HostRule("example.com", "/de/", "block"),
    HostRule("org", "/fr/", "allow"),
)
PATTERN_RULES = (
    PatternRule("spam-farm", r"\bspam-farm\b"),
    PatternRule("cheap-pills", r"\bcheap-pills\b"),
    PatternRule("casino", r"\bcasino[0-9]*\b"),
    PatternRule("adult", r"\b(?:xxx|porn)\b"),
    PatternRule("login", r"/wp-login\.php\b"),
    PatternRule("payload", r"\.(?:exe|msi|apk|dmg)(?:$|[?#])"),
    PatternRule("affiliate", r"[?&]aff_id=[0-9]+\b"),
    PatternRule("session", r"[?&]phpsessid=[0-9a-f]{16,}"),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


#: The parts of a regular expression, one level of groups deep.
_PARTS = re.compile(r"\\[bB]|\\.|\[[^\]]*\]|\((?:[^()]|\([^()]*\))*\)|[*+?]\??|\{[^}]*\}|[\^$|]|.", re.S)


def _ends(part: str | None) -> bool:
    """Whether no token runs on over this part."""
    if part and part.startswith("(?:"):
        return all(_ends(x) for x in part[3:-1].split("|"))
    return part is None or part in ("\\b", "^", "$") or bool(re.fullmatch(r"\\\W|[^\w\\\[\]().*+?{}|]|\[[^\w^\\]*\]", part))


def literal_tokens(regex: str) -> list[str]:
    """Runs of [a-z0-9_] that every match of regex holds as whole tokens: plain
    characters on the top level, closed on both sides by an assertion, another
    plain character, or a class without token characters."""
    return [t for s in _sets(regex) if s.whole for t in s.tokens]


def token_sets(regex: str) -> list[frozenset[str]]:
    """Sets of tokens (whole, or without the digits at their end) of which every
    match of regex holds at least one."""
    return [s.tokens for s in _sets(regex)]


@dataclass(frozen=True)
class _Set:
    tokens: frozenset[str]
    whole: bool = True


def _sets(regex: str) -> list[_Set]:
    parts = _PARTS.findall(regex)
    if "|" in parts:
        return []
    out, run, closed = [], "", False
    for i, part in enumerate([*parts, None]):
        follows = parts[i + 1] if part is not None and i + 1 < len(parts) else None
        varies = follows is not None and follows[0] in "*+?{"
        if part is not None and re.fullmatch(r"[a-z0-9_]", part) and not varies:
            run += part
            continue
        stem = run.rstrip("0123456789")
        # the regex may end inside a longer token: only an assertion closes it there
        if run and closed and part is not None and _ends(part) and not varies:
            out.append(_Set(frozenset([run])))
        elif stem and closed and part in ("[0-9]", "\\d") and varies and i + 2 < len(parts) and _ends(parts[i + 2]):
            out.append(_Set(frozenset([stem]), False))
        elif closed and not run and not varies and follows is not None and _ends(follows) and re.fullmatch(r"\(\?:[a-z0-9_]+(?:\|[a-z0-9_]+)*\)", part or ""):
            out.append(_Set(frozenset(part[3:-1].split("|")), False))
        run = ""
        closed = part is not None and _ends(part) and not varies
    return out


def tokens(url: Column) -> Column:
    whole = F.regexp_extract_all(url, F.lit("([a-z0-9_]+)"), 1)
    return F.array_union(whole, F.transform(whole, lambda t: F.rtrim(t, F.lit("0123456789"))))


def index(pages: DataFrame, rules: tuple[PatternRule, ...]) -> dict[str, list[PatternRule]]:
    """token to rules; rules without a token are under the empty string."""
    own = {r: token_sets(r.regex) for r in rules}
    known = sorted({t for sets in own.values() for s in sets for t in s})
    counts = dict.fromkeys(known, 0)
    if known:
        found = F.explode(tokens(_lower(F.col("url")))).alias("token")
        seen = pages.select(found).groupBy("token").count()
        if len(known) <= INLINE_RULES:
            seen = pages.select(F.explode(F.array_intersect(tokens(_lower(F.col("url"))), F.array(*map(F.lit, known)))).alias("token")).groupBy("token").count()
        else:
            seen = seen.join(F.broadcast(pages.sparkSession.createDataFrame([(t,) for t in known], "token string")), "token", "left_semi")
        counts |= {r.token: r["count"] for r in seen.collect()}
    filed: dict[str, list[PatternRule]] = {}
    for r in rules:
        for t in min(own[r], key=lambda s: (sum(counts[t] for t in s), sorted(s)), default=[""]):
            filed.setdefault(t, []).append(r)
    return filed


def _lower(url: Column) -> Column:
    return F.translate(F.coalesce(url.cast("string"), F.lit("")), UPPER, LOWER)


def host_and_path(url: Column) -> tuple[Column, Column]:
    full = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    url = F.coalesce(url.cast("string"), F.lit(""))
    return F.translate(F.regexp_extract(url, full, 1), UPPER, LOWER), F.regexp_extract(url, full, 2)


def _host_rule(host: Column, path: Column, rules: tuple[HostRule, ...], give: str) -> Column:
    """The longest rule that fits; of equals the first by name."""
    out = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (-len(r.name), r.name), reverse=True):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.lit(getattr(r, give))).otherwise(out)
    return out


_KIND = "array<struct<rank:string,name:string,regex:string>>"


def fetched(pages: DataFrame, patterns: tuple[PatternRule, ...]) -> DataFrame:
    """page_id, url, host, path and rules, the pattern rules that run on the URL."""
    filed = index(pages, patterns)
    always = filed.pop("", [])
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", _lower(F.col("url")).alias("url"), host.alias("host"), path.alias("path"))
    one = lambda r: F.struct(F.lit("1" if r.verdict == "allow" else "0").alias("rank"), F.lit(r.name).alias("name"), F.lit(r.regex).alias("regex"))
    none = F.expr(f"cast(array() as {_KIND})")
    base = F.array(*map(one, always)).cast(_KIND) if always else none
    if len(patterns) > INLINE_RULES:
        return _joined(rows, filed).withColumn("rules", F.concat(F.coalesce(F.col("rules"), none), base))
    if not filed:
        return rows.withColumn("rules", base)
    rows = rows.withColumn("found", F.array_intersect(tokens(F.col("url")), F.array(*map(F.lit, sorted(filed)))))
    pairs = [x for t in sorted(filed) for x in (F.lit(t), F.array(*map(one, filed[t])))]
    own = F.array_distinct(F.flatten(F.transform("found", lambda t: F.element_at(F.create_map(*pairs), t))))
    return rows.withColumn("rules", F.when(F.size("found") > 0, F.concat(own.cast(_KIND), base)).otherwise(base)).drop("found")


def judge(pages: DataFrame, hosts: tuple[HostRule, ...] = HOST_RULES, patterns: tuple[PatternRule, ...] = PATTERN_RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, and pattern: the pattern rule that
    decided (the first by verdict, block before allow, then by name)."""
    hit = F.array_min(F.filter("rules", lambda r: F.regexp_like(F.col("url"), r.regex)))
    rows = fetched(pages, patterns).withColumn("hit", hit)
    pattern = F.when(F.col("rule").isNull(), F.col("hit.name"))
    named = rows.withColumn("rule", _host_rule(F.col("host"), F.col("path"), hosts, "name")).withColumn("by_host", _host_rule(F.col("host"), F.col("path"), hosts, "verdict"))
    return named.select(
        "page_id", "host", "path", "rule",
        F.coalesce(F.col("by_host"), F.when(F.col("hit.rank") == "0", F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
        pattern.alias("pattern"),
    )


def _joined(rows: DataFrame, filed: dict[str, list[PatternRule]]) -> DataFrame:
    """The same fetch for large rule sets: the tokens of distinct URLs meet the
    index, one row a token, and what they fetch goes back to the URLs."""
    spark = rows.sparkSession
    table = spark.createDataFrame([(t, "1" if r.verdict == "allow" else "0", r.name, r.regex) for t in filed for r in filed[t]], "token string, rank string, name string, regex string")
    held = table.groupBy("token").agg(F.collect_list(F.struct("rank", "name", "regex")).alias("filed"))
    some = rows.select("url", F.explode(tokens(F.col("url"))).alias("token")).join(F.broadcast(held), "token")
    own = some.groupBy("url").agg(F.array_distinct(F.flatten(F.collect_list("filed"))).alias("rules"))
    return rows.join(own, "url", "left")
