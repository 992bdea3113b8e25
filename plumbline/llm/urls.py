"""URL filters: longest matching rules, and empirical-Bayes reputation of hosts for the rest.

Outcomes of labelled pages (good or bad) are counted per host. The bad rate of a suffix is
shrunk to that of all pages, that of a registered domain to its suffix's, and that of a host to its
domain's, by beta-binomial priors whose strength is estimated at each level from how much the
counts spread beyond chance. A url is blocked if the lower posterior bound of its host's
bad rate exceeds a threshold, so a host with few pages follows its parents.

Defined results: a null url or one without ``://`` has an empty host and path, fits no
rule and is judged by the reputation of the empty host; null outcomes are no outcome;
repeated rows count each; of equally long rules a blocking one wins; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Suffixes of two labels under which names are registered.
TWO_LABEL_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.jp", "or.jp", "ne.jp", "co.nz", "com.br", "com.cn", "com.mx", "co.in", "co.za", "com.tr", "com.ar")


@dataclass(frozen=True)
class Rule:
    """Blocks or allows ``host`` with its subdomains where the path starts with ``path``."""

    action: str
    host: str
    path: str = ""

    @property
    def text(self) -> str:
        return self.host + self.path


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (letters A-Z lowered) and path of a url; both empty without ``://``."""
    known = F.coalesce(F.locate("://", url) > 0, F.lit(False))
    rest = F.when(known, F.substr(url, F.locate("://", url) + 3)).otherwise("")
    raw = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(raw) + 1), r"^[^?#]*", 0)
    return F.translate(raw, UPPER, LOWER), path


def matched_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """(text, action) of the longest rule that fits, or nulls: one chain of comparisons, no join."""
    text, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.text), r.action == "block", r.text)):  # later ones win
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        text, action = F.when(fits, r.text).otherwise(text), F.when(fits, r.action).otherwise(action)
    return text, action


def domain_and_suffix(host: Column) -> tuple[Column, Column]:
    two = F.substring_index(host, ".", -2)
    double = two.isin(*TWO_LABEL_SUFFIXES)
    return F.when(double, F.substring_index(host, ".", -3)).otherwise(two), F.when(double, two).otherwise(F.substring_index(host, ".", -1))


def strength(children: DataFrame) -> float:
    """Prior strength of a level from its children's counts ``n``, ``x`` and expected rate ``m``.

    The method of moments of the beta-binomial: ``E (x - n m)^2 = n m (1 - m) (1 + (n - 1) rho)``.
    """
    v = F.col("n") * F.col("m") * (1 - F.col("m"))
    row = children.agg(F.sum((F.col("x") - F.col("n") * F.col("m")) ** 2 - v), F.sum(v * (F.col("n") - 1))).first()
    if not row[1]:
        return 100.0
    rho = min(max(row[0] / row[1], 1e-4), 0.5)
    return (1 - rho) / rho


def reputation(outcomes: DataFrame, z: float = 1.645) -> DataFrame:
    """Posterior of each host's bad rate from ``host``, ``bad`` (0, 1 or null).

    Returns ``host``, ``n``, ``x`` (bad ones), ``rate`` (posterior mean) and ``bound`` (``z`` deviations below it).
    """
    domain, suffix = domain_and_suffix(F.col("host"))
    hosts = written(outcomes.groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("x")).select("host", "n", "x", domain.alias("domain"), suffix.alias("suffix")), "hosts")
    counts = lambda *keys: hosts.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("x").alias("x"))
    total = hosts.agg(F.sum("n"), F.sum("x")).first()
    mean = (total[1] + 0.5) / (total[0] + 1.0) if total[0] is not None else 0.5

    def shrunk(children: DataFrame) -> DataFrame:
        s = strength(children)
        return children.withColumn("rate", (F.col("x") + s * F.col("m")) / (F.col("n") + s)).withColumn("weight", F.col("n") + s)

    top = shrunk(counts("suffix").withColumn("m", F.lit(mean)))
    middle = shrunk(counts("domain", "suffix").join(top.select("suffix", F.col("rate").alias("m")), "suffix"))
    low = shrunk(hosts.join(middle.select("domain", F.col("rate").alias("m")), "domain"))
    bound = F.col("rate") - z * F.sqrt(F.col("rate") * (1 - F.col("rate")) / (F.col("weight") + 1))
    return low.select("host", "n", "x", "rate", bound.alias("bound"))


def judged(pages: DataFrame, rules: list[Rule], bad: Column, id_col: str = "page_id", url_col: str = "url", threshold: float = 0.2, z: float = 1.645) -> DataFrame:
    """Verdict on each url: the rule's, else block if the reputation's bound exceeds ``threshold``.

    ``bad``: outcome of a page (1 bad, 0 good, null unlabelled). Returns ``page_id, host, path, rule, verdict, bound``.
    """
    host, path = host_and_path(F.col(url_col))
    rows = written(pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"), bad.cast("int").alias("bad")), "urls")
    rule, action = matched_rule(F.col("host"), F.col("path"), rules)
    known = rows.join(reputation(rows, z).select("host", "bound"), "host", "left")
    verdict = F.coalesce(action, F.when(F.col("bound") > threshold, "block").otherwise("allow"))
    return known.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("verdict"), "bound")
