"""URL filter: pattern rules found through their rarest literal token.

Every rule is a regular expression with the literal tokens (runs of a-z0-9)
that any URL it matches must hold. Over all pages the tokens of the rules are
counted, and a rule is indexed by its rarest token only. A URL's tokens fetch
candidate rules from that index, and only those run their expression. Rules
without a literal token are candidates of every URL.

All of it is DataFrame operations. Rules are numbered so that the larger
number wins; a page then needs one integer maximum per kind of rule, combined
before the shuffle, keyed by the row (no key is hot).
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.llm.tables import column, cut_lineage

#: A rule table up to this many rules is broadcast (some MB); a longer one is joined by a shuffle.
BROADCAST_RULES = 50_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class SiteRule:
    """host/path rule: its host and all subdomains, paths that start with its path."""

    site: str
    verdict: str

    @property
    def pattern(self) -> str:
        return r"^([^/]*\.)?" + re.sub(r"([^A-Za-z0-9])", r"\\\1", self.site)

    @property
    def tokens(self) -> list[str]:
        whole = re.sub(r"[A-Za-z0-9]+$", "", self.site) if "/" in self.site else self.site
        return sorted(set(re.findall("[a-z0-9]+", whole.lower())))


@dataclass(frozen=True)
class PatternRule:
    """Expression over the lower-cased URL, and tokens each match holds as whole tokens."""

    name: str
    pattern: str
    tokens: tuple[str, ...]
    verdict: str = "block"


#: The site rules of the query: the longest that fits wins.
SITE_RULES = (SiteRule("com/", "allow"), SiteRule("example.com/en/", "block"), SiteRule("www.example.com/en/", "allow"),
              SiteRule("net/es/", "block"), SiteRule("net/fr/", "block"))

#: The method's own verdict where no site rule fits: addresses of sessions,
#: shops' carts, trackers and spam are blocked, all others allowed.
PATTERN_RULES = tuple(PatternRule(w, rf"[/.?&_-]{w}([/.?&=_-]|$)", (w,)) for w in
                      ("login", "logout", "signup", "cart", "checkout", "casino", "poker", "viagra", "porn", "adserver", "doubleclick")) + (
    PatternRule("tracking feed", r"[?&]utm_source=feed(&|#|$)", ("utm", "source", "feed")),
    PatternRule("session id", r"[?&;](phpsessid|jsessionid)=", ()),
)


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for a null and without ://."""
    rest = F.when(url.contains("://"), F.expr("substring(_url, instr(_url, '://') + 3)")).otherwise("")
    return (F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), _UPPER, _LOWER), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1))


def _rule_table(spark: SparkSession, sites, patterns) -> DataFrame:
    ordered = sorted(sites, key=lambda r: (len(r.site), r.site))
    rows = [(i, "site", r.site, r.verdict, r.pattern, r.tokens) for i, r in enumerate(ordered)]
    rows += [(i, "pattern", r.name, r.verdict, r.pattern, list(r.tokens)) for i, r in enumerate(patterns)]
    return spark.createDataFrame(rows, "no int, kind string, rule string, verdict string, pattern string, tokens array<string>")


def judge_urls(pages: DataFrame, sites=SITE_RULES, patterns=PATTERN_RULES, id_col: str = "page_id", url_col: str = "url",
               default: str = "allow") -> DataFrame:
    """(page_id, host, path, rule, verdict, pattern_rule) of every row of pages.

    A null URL, an empty one and one without ``://`` have an empty host and
    path; no site rule fits them. Of pattern rules the last listed one that
    matches decides. Repeated rows stay, each judged for itself; null ids are
    carried; other columns are ignored. An empty table gives no rows."""
    spark = pages.sparkSession
    hint = F.broadcast if len(sites) + len(patterns) <= BROADCAST_RULES else (lambda df: df)
    rules = _rule_table(spark, sites, patterns)
    src = (pages.select(F.monotonically_increasing_id().alias("row"), column(pages, id_col).cast("long").alias("page_id"),
                        F.coalesce(column(pages, url_col), F.lit("")).alias("_url"))
           .withColumn("tokens", F.array_distinct(F.split(F.lower("_url"), "[^a-z0-9]+"))))
    # How often each rule token is in the URLs; then each rule's rarest.
    used = rules.select(F.explode("tokens").alias("token")).distinct()
    seen = (src.select(F.explode("tokens").alias("token")).join(hint(used), "token").groupBy("token").count())
    spread = rules.select("no", "kind", F.explode_outer("tokens").alias("token")).join(seen, "token", "left")
    rarest = (spread.groupBy("no", "kind")
              .agg(F.min(F.struct(F.coalesce("count", F.lit(0)).alias("count"), F.coalesce("token", F.lit("")).alias("token"))).alias("least")))
    index = cut_lineage(rules.select("no", "kind", "pattern").join(rarest, ["no", "kind"]).select("no", "kind", "pattern", F.col("least.token").alias("token")))
    host, path = split_url(F.col("_url"))
    tried = (src.select("row", "page_id", host.alias("host"), path.alias("path"), F.lower("_url").alias("low"),
                        F.explode(F.array_union("tokens", F.array(F.lit("")))).alias("token"))
             .join(hint(index), "token", "left")
             .withColumn("fits", F.expr("CASE WHEN kind = 'site' THEN rlike(concat(host, path), pattern) WHEN kind = 'pattern' THEN rlike(low, pattern) END")))
    best = (tried.groupBy("row", "page_id", "host", "path")
            .agg(F.max(F.expr("CASE WHEN fits AND kind = 'site' THEN no END")).alias("site_no"),
                 F.max(F.expr("CASE WHEN fits AND kind = 'pattern' THEN no END")).alias("pattern_no")))
    site = rules.filter("kind = 'site'").select(F.col("no").alias("site_no"), "rule", F.col("verdict").alias("site_verdict"))
    other = rules.filter("kind = 'pattern'").select(F.col("no").alias("pattern_no"), F.col("rule").alias("pattern_rule"), F.col("verdict").alias("pattern_verdict"))
    return (best.join(hint(site), "site_no", "left").join(hint(other), "pattern_no", "left")
            .select("page_id", "host", "path", "rule", F.coalesce("site_verdict", "pattern_verdict", F.lit(default)).alias("verdict"), "pattern_rule"))
