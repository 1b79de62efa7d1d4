"""URL filters: fixed rules first, then an empirical-Bayes reputation of hosts.

Labelled page outcomes (bad or not) are counted by host, registered domain and suffix. At
each level a beta-binomial prior, whose strength is fitted by moments to the spread of that
level's groups around their parents, shrinks a group's rate towards its parent's posterior
mean: suffix to the corpus, domain to suffix, host to domain. A prior counts for no more
observations than the parent's posterior rests on. A host is blocked when the lower bound of
its posterior bad rate is above a threshold, so that a few labels don't block.

All of it is DataFrame operations. The bound is that of a normal distribution with the
posterior's mean and standard error. A port isn't part of the domain. Addresses of numbers
are their own domain and suffix, so that only the corpus is above them.

Null urls and urls without ``://`` have an empty host and path, which are judged like any
other host; long urls are whole. Pages without labels take part with none. Repeated rows of
a page are judged alike, and each counts with the page's outcome. Of rules of one length
that fit, the later of RULES holds. Empty tables give no rows. Extra columns go.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import shared

#: (host, path, verdict): fixed values of the contract.
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
#: Labels below a country's that make a suffix with it, as in co.uk or com.br; fixed values of public knowledge.
SECOND_LEVELS = ("ac", "co", "com", "edu", "go", "gob", "gov", "mil", "ne", "net", "or", "org")
NUMBERS, PORT = r"^[0-9.]+$|^\[", ":[0-9]*$"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_url(url):
    """(host, path) columns of a url column."""
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)  # empty where nothing fits
    rest = F.coalesce(rest, F.lit(""))
    return F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), UPPER, LOWER), F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)


def rule_of(host, path):
    """The longest rule that fits, and its verdict, as a struct; null if none does."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for h, p, verdict in sorted(RULES, key=lambda r: len(r[0] + r[1])):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        found = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def _last(labels, n: int):
    return F.array_join(F.slice(labels, F.greatest(F.size(labels) - n + 1, F.lit(1)), n), ".")


def _parts(host):
    """The host without a port, its labels, whether it's an address, and whether its suffix has two labels."""
    bare = F.regexp_replace(host, PORT, "")
    labels = F.split(bare, r"\.")
    two = (F.size(labels) > 1) & F.element_at(labels, -1).rlike("^[a-z]{2}$") & F.get(labels, F.size(labels) - 2).isin(*SECOND_LEVELS)
    return bare, labels, bare.rlike(NUMBERS), two


def domain_of(host):
    bare, labels, address, two = _parts(host)
    return F.when(address, bare).when(two, _last(labels, 3)).otherwise(_last(labels, 2))


def suffix_of(host):
    bare, labels, address, two = _parts(host)
    return F.when(address, bare).when(two, _last(labels, 2)).otherwise(F.element_at(labels, -1))


def _strength(groups: DataFrame) -> float:
    """Prior observations, from how far groups (n, k, prior) spread beyond chance; one row comes to the driver."""
    m = F.col("prior")
    row = groups.filter("n > 0").agg(
        F.count(F.lit(1)).alias("g"), F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n").cast("double")).alias("nn"), F.sum((F.col("k") - F.col("n") * m) * (F.col("k") - F.col("n") * m) / F.col("n")).alias("ss"), F.sum(F.col("n") * m * (1 - m)).alias("v")
    ).first()
    if not row["g"] or row["g"] < 2 or not row["v"]:
        return 100.0
    v, freedom = row["v"] / row["n"], row["g"] - 1
    spread = row["n"] - row["nn"] / row["n"] - freedom
    rho = (row["ss"] - v * freedom) / (v * spread) if spread > 0 else 0.0
    rho = min(max(rho, 1e-3), 0.9)
    return (1 - rho) / rho


def reputation(pages: DataFrame, outcomes: DataFrame) -> DataFrame:
    """host, n, k, p_bad (posterior mean) and its standard error, for every host of pages.

    outcomes: page_id and bad (0 or 1), at most one row a page counts (the largest bad).
    """
    host, _ = split_url(F.col("url"))
    one = shared.with_columns(outcomes, "page_id", "bad").filter("page_id IS NOT NULL AND bad IS NOT NULL").groupBy("page_id").agg(F.max("bad").cast("long").alias("bad"))
    hosts = shared.with_columns(pages, "page_id", "url").select("page_id", host.alias("host")).join(one, "page_id", "left").groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("k"))
    hosts = shared.materialise(hosts.withColumns({"domain": domain_of(F.col("host")), "suffix": suffix_of(F.col("host"))}), "hosts")
    total = hosts.agg(F.sum("n").alias("n"), F.sum("k").alias("k")).first()
    above = ((total["k"] or 0) + 0.5) / ((total["n"] or 0) + 1)
    parent = None
    for level, up in (("suffix", None), ("domain", "suffix"), ("host", "domain")):
        keys = [level] + ([up] if up else [])
        groups = hosts if level == "host" else hosts.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
        groups = groups.withColumns({"prior": F.lit(above), "weight": F.lit(1e18)}) if parent is None else groups.join(parent, up)
        s = F.least(F.lit(_strength(groups)), F.col("weight"))
        a, b = s * F.col("prior") + F.col("k"), s * (1 - F.col("prior")) + F.col("n") - F.col("k")
        groups = groups.withColumns({"p_bad": a / (a + b), "se": F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))), "rests": a + b})
        parent = groups.select(level, F.col("p_bad").alias("prior"), F.col("rests").alias("weight"))
    return groups.select("host", "n", "k", "p_bad", "se")


def judge(pages: DataFrame, outcomes: DataFrame, threshold: float = 0.5, z: float = 1.645) -> DataFrame:
    """page_id, host, path, rule, verdict of every page. Blocked hosts alone are joined to the pages."""
    host, path = split_url(F.col("url"))
    bad = reputation(pages, outcomes).filter(F.col("p_bad") - z * F.col("se") > threshold).select("host", F.lit(True).alias("bad_host"))
    rows = shared.with_columns(pages, "page_id", "url").select("page_id", host.alias("host"), path.alias("path"))
    rows = rows.withColumn("found", rule_of(F.col("host"), F.col("path")))
    verdict = F.coalesce(F.col("found.verdict"), F.when(F.col("bad_host"), "block").otherwise("allow"))
    return rows.join(bad, "host", "left").select("page_id", "host", "path", F.col("found.rule").alias("rule"), verdict.alias("verdict"))


def op2_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's outcome is the label of the document with its id: bad if of low quality or toxic."""
    labels = shared.table(spark, sf_dir, "labels")
    outcomes = labels.select(F.col("doc_id").alias("page_id"), ((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int").alias("bad"))
    return judge(shared.table(spark, sf_dir, "pages"), outcomes)


def _level_sql(name: str, groups: str) -> str:
    return f"""
{name}_g AS ({groups}),
{name}_t AS (SELECT count(*) AS g, sum(n) AS nt, sum(n * n::DOUBLE) AS nn, sum((k - n * prior) * (k - n * prior) / n) AS ss, sum(n * prior * (1 - prior)) AS v FROM {name}_g WHERE n > 0),
{name}_r AS (SELECT CASE WHEN g < 2 OR coalesce(v, 0) = 0 THEN NULL ELSE least(greatest(CASE WHEN nt - nn / nt - (g - 1) > 0
  THEN (ss - v / nt * (g - 1)) / (v / nt * (nt - nn / nt - (g - 1))) ELSE 0 END, 1e-3), 0.9) END AS rho FROM {name}_t),
{name}_s AS (SELECT coalesce((1 - rho) / rho, 100.0) AS s FROM {name}_r),
{name}_p AS (SELECT *, least(s, weight) * prior + k AS a, least(s, weight) * (1 - prior) + n - k AS b FROM {name}_g, {name}_s)"""


_RULE_CASES = "\n".join(
    f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{h + p}'" for h, p, _ in sorted(RULES, key=lambda r: -len(r[0] + r[1]))
)
_SECOND = ", ".join(f"'{x}'" for x in SECOND_LEVELS)
OP2_SQL = f"""
WITH u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
r AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
o AS (SELECT doc_id AS page_id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS bad FROM labels WHERE quality IS NOT NULL OR toxic IS NOT NULL GROUP BY 1),
h0 AS (SELECT host, count(bad) AS n, coalesce(sum(bad), 0) AS k FROM r LEFT JOIN o USING (page_id) GROUP BY 1),
h1 AS (SELECT *, regexp_replace(host, '{PORT}', '') AS bare FROM h0),
h2 AS (SELECT *, string_split(bare, '.') AS l, regexp_matches(bare, '{NUMBERS}') AS address FROM h1),
h3 AS (SELECT *, len(l) > 1 AND regexp_matches(l[-1], '^[a-z]{{2}}$') AND l[-2] IN ({_SECOND}) AS two FROM h2),
h AS (SELECT host, n, k, CASE WHEN address THEN bare WHEN two THEN array_to_string(l[-3:], '.') ELSE array_to_string(l[-2:], '.') END AS domain,
  CASE WHEN address THEN bare WHEN two THEN array_to_string(l[-2:], '.') ELSE l[-1] END AS suffix FROM h3),
{_level_sql('s', "SELECT suffix, sum(n) AS n, sum(k) AS k, (SELECT (sum(k) + 0.5) / (sum(n) + 1) FROM h) AS prior, 1e18 AS weight FROM h GROUP BY 1")},
{_level_sql('d', "SELECT domain, sum(h.n) AS n, sum(h.k) AS k, any_value(a / (a + b)) AS prior, any_value(a + b) AS weight FROM h JOIN s_p USING (suffix) GROUP BY domain, suffix")},
{_level_sql('f', "SELECT host, h.n, h.k, a / (a + b) AS prior, a + b AS weight FROM h JOIN d_p USING (domain)")},
bad AS (SELECT host FROM f_p WHERE a / (a + b) - 1.645 * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) > 0.5),
w AS (SELECT page_id, host, path, CASE {_RULE_CASES} END AS rule FROM r)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ({", ".join(f"'{h + p}'" for h, p, v in RULES if v == "block")}) THEN 'block' WHEN rule IS NOT NULL THEN 'allow' WHEN host IN (SELECT host FROM bad) THEN 'block' ELSE 'allow' END AS verdict
FROM w
"""
