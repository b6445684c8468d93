"""URL filters: listed rules first, then empirical-Bayes host reputation.

Every page has a labelled outcome (bad or not). A host's rate of bad pages is
shrunk through beta-binomial priors: the suffix towards all pages, the
registered domain towards its suffix, the host towards its domain. The
strength of each prior comes from how much rates differ between the groups of
its level (moment estimate). A host is blocked when the lower bound of its
posterior rate passes a limit, so a host with few pages follows its domain.

Aggregates have a map-side part, so a host with a third of all pages is one
row per task; its pages are salted when they meet the verdicts.

Cases: a null url or one without ``://`` has an empty host and path and is
judged like any other host; a null outcome is no label; without labels nothing
is blocked but by rules; extra columns named in ``keep`` pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import materialise, table

#: (rule, verdict); a rule is a host and the start of a path.
RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]
MAX_RULES = 1_000
#: A host is blocked when mean - BOUND_SD * sd of its posterior passes BAD_RATE.
BAD_RATE = 0.5
BOUND_SD = 2.0
#: Limits of the intra-group correlation, so of a prior's strength (1/r - 1).
MIN_CORRELATION, MAX_CORRELATION = 0.001, 0.5
#: A page counts as bad with fewer words, or this share (percent) of marked words.
MIN_WORDS = 20
MARKED_PERCENT = 30
SALTS = 16

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), "://([^/?#]*)", 1)
    return F.translate(found, _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), "://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; nulls without one."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"at most {MAX_RULES} rules are tested one by one")
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: (len(r[0]), r[0])):  # the longest is tested first
        own_host, own_path = text[: text.index("/")], text[text.index("/") :]
        fits = ((host == own_host) | host.endswith("." + own_host)) & path.startswith(own_path)
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def page_outcome(html: Column) -> Column:
    """True for a page whose visible text is short or full of marks; null without html."""
    text = F.regexp_replace(html, "<[^>]*>", " ")
    n_words = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))
    n_marked = F.regexp_count(text, F.lit(r"[#*$%|]+|!!"))
    return (n_words < MIN_WORDS) | (100 * n_marked >= MARKED_PERCENT * n_words)


def _strength(groups: DataFrame) -> float:
    """1/r - 1 for the intra-group correlation r of (n, bad) groups."""
    rate = F.col("bad") / F.col("n")
    total = groups.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"), F.count(F.lit(1)).alias("g")).first()
    n, g = total["n"] or 0, total["g"]
    if g < 2 or n <= g:
        return 1 / MIN_CORRELATION - 1
    mean = total["bad"] / n
    r = groups.agg(
        F.sum(F.col("n") * (rate - mean) * (rate - mean)).alias("between"),
        F.sum(F.col("n") * rate * (1 - rate)).alias("within"),
        F.sum(F.col("n") * F.col("n")).alias("squares"),
    ).first()
    between, within = r["between"] / (g - 1), r["within"] / (n - g)
    size = (n - r["squares"] / n) / (g - 1)
    spread = between + (size - 1) * within
    correlation = (between - within) / spread if spread > 0 else 0.0
    return 1 / min(MAX_CORRELATION, max(MIN_CORRELATION, correlation)) - 1


def host_reputation(outcomes: DataFrame) -> DataFrame:
    """(host, mean, bound, blocked) from (host, bad) rows; ``bad`` null is no label."""
    labels = F.split("host", r"\.")
    # Written once: the moments below read it several times, the pages only once.
    hosts = materialise(
        outcomes.groupBy("host")
        .agg(F.count("bad").alias("n"), F.coalesce(F.sum(F.col("bad").cast("long")), F.lit(0)).alias("bad"))
        .withColumn("suffix", F.element_at(labels, -1))
        .withColumn("domain", F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2), ".")),
        "hosts",
    )

    def level(key: str) -> DataFrame:
        return hosts.groupBy(key).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))

    domains, suffixes = level("domain"), level("suffix")
    total = hosts.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    mean = total["bad"] / total["n"] if total["n"] else 0.0
    by_host, by_domain, by_suffix = (_strength(x.filter("n > 0")) for x in (hosts, domains, suffixes))
    suffixes = suffixes.select("suffix", ((F.col("bad") + by_suffix * mean) / (F.col("n") + by_suffix)).alias("suffix_mean"))
    domains = domains.select("domain", F.col("n").alias("domain_n"), F.col("bad").alias("domain_bad"))
    a = F.col("bad") + by_host * F.col("domain_mean")
    b = F.col("n") - F.col("bad") + by_host * (1 - F.col("domain_mean"))
    rate = F.col("mean")
    return (
        hosts.join(suffixes, "suffix")
        .join(domains, "domain")
        .withColumn("domain_mean", (F.col("domain_bad") + by_domain * F.col("suffix_mean")) / (F.col("domain_n") + by_domain))
        .withColumn("mean", a / (a + b))
        .withColumn("bound", rate - BOUND_SD * F.sqrt(rate * (1 - rate) / (a + b + 1)))
        .select("host", "mean", "bound", (F.col("bound") > BAD_RATE).alias("blocked"))
    )


def filter_urls(pages: DataFrame, keep: list[str], rules: list[tuple[str, str]] = RULES) -> DataFrame:
    """``keep`` of every page with host, path, rule, verdict and the host's bound."""
    added = ["host", "path", "rule", "verdict", "bound"]
    kept = [c for c in keep if c.lower() not in added]
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    reputation = host_reputation(pages.select(host.alias("host"), page_outcome(F.col("html")).alias("bad")))
    salted = reputation.select(
        "host", "bound", "blocked", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt")
    )
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    return (
        pages.select(*kept, host.alias("host"), path.alias("path"), F.pmod(F.xxhash64("url"), F.lit(SALTS)).cast("int").alias("_salt"))
        .join(salted, ["host", "_salt"], "left")
        .select(
            *kept,
            "host",
            "path",
            rule.alias("rule"),
            F.coalesce(verdict, F.when(F.col("blocked"), "block").otherwise("allow")).alias("verdict"),
            "bound",
        )
    )


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"), ["page_id"]).withColumn("bound", F.round("bound", 6))


def _oracle() -> str:
    strength = (
        "SELECT CASE WHEN g < 2 OR n <= g THEN 1 / {lo} - 1 ELSE 1 / least({hi}, greatest({lo}, CASE WHEN btw + (size - 1) * wth > 0 "
        "THEN (btw - wth) / (btw + (size - 1) * wth) ELSE 0 END)) - 1 END AS s FROM (SELECT n, g, q / (g - 1) AS btw, "
        "w / (n - g) AS wth, (n - sq / n) / (g - 1) AS size FROM (SELECT sum(n) AS n, count(*) AS g, "
        "sum(n * pow(bad / n - (SELECT sum(bad) / sum(n) FROM {t}), 2)) AS q, sum(n * (bad / n) * (1 - bad / n)) AS w, "
        "sum(n * n) AS sq FROM {t} WHERE n > 0))"
    )
    s = {t: strength.format(t=t, lo=MIN_CORRELATION, hi=MAX_CORRELATION) for t in ("hosts", "domains", "suffixes")}
    fits = []
    for text, says in sorted(RULES, key=lambda r: (-len(r[0]), r[0])):
        host, path = text[: text.index("/")], text[text.index("/") :]
        fits.append((f"(host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}')", text, says))
    return f"""
WITH p AS (SELECT page_id, html, translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host,
  regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path FROM pages),
o AS (SELECT host, regexp_replace(html, '<[^>]*>', ' ', 'g') AS t FROM p),
c AS (SELECT host, len(regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+')) AS w, len(regexp_extract_all(t, '[#*$%|]+|!!')) AS m, t FROM o),
b AS (SELECT host, CASE WHEN t IS NOT NULL THEN (w < {MIN_WORDS} OR 100 * m >= {MARKED_PERCENT} * w)::INT END AS bad FROM c),
hosts AS (SELECT host, count(bad)::DOUBLE AS n, coalesce(sum(bad), 0)::DOUBLE AS bad,
  split_part(host, '.', -1) AS suffix, array_to_string(list_slice(string_split(host, '.'), -2, -1), '.') AS domain FROM b GROUP BY host),
domains AS (SELECT domain, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY domain),
suffixes AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY suffix),
k AS (SELECT ({s['hosts']}) AS sh, ({s['domains']}) AS sd, ({s['suffixes']}) AS ss, (SELECT sum(bad) / sum(n) FROM hosts) AS mean),
sm AS (SELECT suffix, (bad + ss * mean) / (n + ss) AS sm FROM suffixes, k),
dm AS (SELECT host, h.n, h.bad, sh, (d.bad + sd * sm) / (d.n + sd) AS dm FROM hosts h JOIN sm USING (suffix) JOIN domains d USING (domain), k),
post AS (SELECT host, (bad + sh * dm) / (n + sh) AS mean, n + sh AS ab FROM dm),
rep AS (SELECT host, mean - {BOUND_SD} * sqrt(mean * (1 - mean) / (ab + 1)) AS bound FROM post)
SELECT page_id, host, path, CASE {' '.join(f"WHEN {f} THEN '{t}'" for f, t, _ in fits)} END AS rule,
  CASE {' '.join(f"WHEN {f} THEN '{v}'" for f, _, v in fits)} WHEN bound > {BAD_RATE} THEN 'block' ELSE 'allow' END AS verdict,
  round(bound, 6) AS bound FROM p JOIN rep USING (host)
"""


ORACLE_SQL = _oracle()
