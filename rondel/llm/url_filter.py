"""URL filters: fixed rules first, then the reputation of hosts learned from labelled pages.

Pages with a known outcome (good or bad) are counted per host, registered domain and suffix. The share of good pages is
shrunk by beta-binomial priors from the top down: the prior of a suffix is centred on all pages, that of a domain on its suffix, that of a
host on its domain. How strongly each level is pulled is estimated from how much its members differ. A page is
blocked if even the upper bound of its host's good share is too low. Everything is DataFrame expressions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from rondel.llm.shared import LOWER, UPPER, quoted, stored

# Names of several labels under which domains are registered; a default for callers without a list of their own. Fixed values.
SHARED_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.nz", "co.jp", "or.jp",
                   "ne.jp", "com.br", "com.cn", "com.mx", "co.in", "co.kr", "co.za", "com.tr", "com.tw")
MIN_GOOD = 0.5
Z = 1.6448536269514722  # one-sided 95 %

# Names with at least one in so many rows of a table are joined apart; there cannot be more of them than that.
HOT_SHARE = 1000

Rule = tuple[str, str, str]  # verdict, host, path
LEVELS = ("suffix", "domain", "host")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://`` or url."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(found, F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest fitting rule as a struct ``rule, verdict``, or null.

    A rule fits its host and all subdomains if the path starts with the rule's. Of equally long rules the one with the
    longer host wins, then a block. The list is configuration: one branch of a single expression per rule.
    """
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), -len(r[1]), r[0] != "block"))
    found = F.lit(None).cast("struct<rule: string, verdict: string>")
    for verdict, name, start in reversed(ordered):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        found = F.when(fits, F.struct(F.lit(name + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def _labels(host: Column) -> Column:
    bare = F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":[0-9]*$", "")
    return F.split(bare, r"\.", -1)


def _last(labels: Column, n: int) -> Column:
    return F.array_join(F.slice(labels, F.greatest(F.size(labels) - (n - 1), F.lit(1)), n), ".")


def _by_suffix(host: Column, shared: Sequence[str], more: int) -> Column:
    """The last labels of a host: those of the longest of the ``shared`` suffixes it ends in, or one, and ``more``."""
    labels = _labels(host)
    found = _last(labels, 1 + more)
    lengths = {}
    for name in shared:
        lengths.setdefault(name.count(".") + 1, []).append(name)
    for n in sorted(lengths):
        found = F.when(_last(labels, n).isin(*lengths[n]), _last(labels, n + more)).otherwise(found)
    return found


def suffix_of(host: Column, shared: Sequence[str] = SHARED_SUFFIXES) -> Column:
    """The longest of the ``shared`` suffixes that ends the host, else its last label."""
    return _by_suffix(host, shared, 0)


def domain_of(host: Column, shared: Sequence[str] = SHARED_SUFFIXES) -> Column:
    """The suffix and one label more (the host itself, if it has no more)."""
    return _by_suffix(host, shared, 1)


def left_join(rows: DataFrame, members: DataFrame, key: str) -> DataFrame:
    """``rows`` left-joined on ``key`` with ``members``, which has a row per key at most; any key may hold most rows.

    Keys with at least one row in ``HOT_SHARE`` are at most that many, so their members are broadcast; their rows are
    dealt over all tasks and meet nothing in the shuffle join of the others. ``rows`` is read twice.
    """
    values = [c for c in members.columns if c != key]
    counts = stored(rows.groupBy(key).count(), "keys")
    total = counts.agg(F.sum("count")).first()[0] or 0
    hot = members.join(counts.filter(F.col("count") * HOT_SHARE >= total).select(key), key)
    hot = hot.select(key, F.struct(*values).alias("_hot"))
    apart = F.lit(1) + F.pmod(F.xxhash64(*rows.columns), F.lit(HOT_SHARE)).cast("int")
    dealt = rows.join(F.broadcast(hot), key, "left").withColumn("_deal", F.when(F.col("_hot").isNull(), F.lit(0)).otherwise(apart))
    found = dealt.join(members.select(key, F.lit(0).alias("_deal"), F.struct(*values).alias("_cold")), [key, "_deal"], "left")
    return found.select(*rows.columns, *[F.coalesce(f"_hot.{c}", f"_cold.{c}").alias(c) for c in values])


def _strength(counts: DataFrame) -> float:
    """The prior's weight in pages, from the overdispersion of ``good`` of ``n`` around ``centre``.

    Under a beta-binomial the squared deviations sum to ``n (1 + (n - 1) rho)`` binomial variances; the
    weight is ``1 / rho - 1``, kept between 0.5 and 1000. One row reaches the driver.
    """
    spread = F.greatest(F.col("centre") * (1 - F.col("centre")), F.lit(1e-6))
    gap = F.col("good") - F.col("n") * F.col("centre")
    pairs = F.sum(F.col("n") * (F.col("n") - 1))
    rho = F.when(pairs > 0, (F.sum(gap * gap / spread) - F.sum("n")) / pairs)
    rho = F.least(F.greatest(F.coalesce(rho, F.lit(0.1)), F.lit(1e-9)), F.lit(1 - 1e-9))
    return counts.agg(F.least(F.greatest(1 / rho - 1, F.lit(0.5)), F.lit(1000.0)).alias("weight")).first()[0]


def _level(counts: DataFrame, label: str) -> DataFrame:
    """Posterior ``a``, ``b`` and mean of every member, from its counts and the ``centre`` above it; stored."""
    weight = _strength(counts)
    a = F.lit(weight) * F.col("centre") + F.col("good")
    b = F.lit(weight) * (1 - F.col("centre")) + F.col("n") - F.col("good")
    return stored(counts.withColumn("a", a).withColumn("b", b).withColumn("mean", a / (a + b)), label)


def reputation(labelled: DataFrame) -> tuple[tuple[float, float], DataFrame, DataFrame, DataFrame]:
    """The posterior of all pages, and those of suffixes, domains and hosts, from rows ``host, domain, suffix, good``."""
    hosts = stored(labelled.groupBy("host", "domain", "suffix").agg(
        F.count("*").cast("double").alias("n"), F.sum(F.col("good").cast("double")).alias("good")), "host-counts")
    n, good = hosts.agg(F.coalesce(F.sum("n"), F.lit(0.0)), F.coalesce(F.sum("good"), F.lit(0.0))).first()
    a, b = good + 1, n - good + 1  # all pages together under a flat prior
    sums = [F.sum("n").alias("n"), F.sum("good").alias("good")]
    suffixes = _level(hosts.groupBy("suffix").agg(*sums).withColumn("centre", F.lit(a / (a + b))), "suffixes")
    domains = _level(hosts.groupBy("domain", "suffix").agg(*sums).join(
        suffixes.select("suffix", F.col("mean").alias("centre")), "suffix"), "domains")
    named = _level(hosts.join(domains.select("domain", F.col("mean").alias("centre")), "domain"), "hosts")
    return ((a, b), suffixes.select("suffix", "a", "b"), domains.select("domain", "a", "b"),
            named.select("host", "a", "b"))


def upper_bound(a: Column, b: Column, z: float = Z) -> Column:
    """Normal approximation of the posterior's upper bound, at most 1."""
    mean = a / (a + b)
    return F.least(mean + z * F.sqrt(mean * (1 - mean) / (a + b + 1)), F.lit(1.0))


def judge(pages: DataFrame, outcomes: DataFrame, rules: Sequence[Rule], min_good: float = MIN_GOOD,
          shared_suffixes: Sequence[str] = SHARED_SUFFIXES) -> DataFrame:
    """``pages`` (``page_id``, ``url``) with ``host, path, rule, verdict, good_bound``.

    ``outcomes``: ``page_id`` and ``good`` (boolean) of labelled pages. A page without rule is blocked if the upper bound of
    its host's good share is below ``min_good``. A host without labels has its domain's posterior, else
    its suffix's, else that of all pages. ``shared_suffixes``: suffixes of any number of labels, longest first.

    * A null url, or one without ``://``, has empty host and path; no rule fits it, and empty hosts are judged like one host.
    * Null outcomes and ids do not count; several outcomes of a page all count. Repeated pages are rows of their own.
    * Empty tables: without outcomes every page has the flat prior and is allowed; without pages there is no row.
    * Counts per host are combined before any shuffle; pages meet one row per host, those of hot hosts without a shuffle
      by host, and so do hosts their domain.
    """
    def named(rows: DataFrame, *more: str) -> DataFrame:
        return rows.select("host", domain_of(F.col("host"), shared_suffixes).alias("domain"),
                           suffix_of(F.col("host"), shared_suffixes).alias("suffix"), *more)

    seen = pages.select(F.col(quoted("page_id")).alias("page_id"), F.col("url").cast("string").alias("url"))
    seen = seen.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    known = outcomes.filter("page_id IS NOT NULL AND good IS NOT NULL").select(F.col("page_id").alias("_id"), "good")
    labelled = named(seen.join(known, F.col("page_id") == F.col("_id")), "good")
    top, suffixes, domains, hosts = reputation(labelled)
    # One row per host of the pages, then its nearest known posterior.
    every = stored(named(seen.select("host").distinct()), "page-hosts")
    a0, b0 = map(F.lit, top)
    chain = left_join(every.join(hosts.toDF("host", "a3", "b3"), "host", "left"), domains.toDF("domain", "a2", "b2"), "domain")
    chain = left_join(chain, suffixes.toDF("suffix", "a1", "b1"), "suffix")
    bounds = stored(chain.select("host", upper_bound(F.coalesce("a3", "a2", "a1", a0), F.coalesce("b3", "b2", "b1", b0))
                                 .alias("good_bound")), "host-bounds")
    rule = rule_of(F.col("host"), F.col("path"), rules)
    return (left_join(seen, bounds, "host").withColumn("_rule", rule).select(
        "page_id", "host", "path", F.col("_rule.rule").alias("rule"),
        F.coalesce(F.col("_rule.verdict"), F.when(F.col("good_bound") < min_good, F.lit("block")).otherwise(F.lit("allow")))
        .alias("verdict"), "good_bound"))


def allowed_pages(pages: DataFrame, outcomes: DataFrame, rules: Sequence[Rule], min_good: float = MIN_GOOD,
                  shared_suffixes: Sequence[str] = SHARED_SUFFIXES) -> DataFrame:
    """The rows of ``judge`` that are not blocked."""
    return judge(pages, outcomes, rules, min_good, shared_suffixes).filter("verdict = 'allow'")
