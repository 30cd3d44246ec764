"""Public suffixes and the domains below them, by rules with wildcards and exceptions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.functions import urls
from strandline.operators.annotate import SMALL


def suffixes(hosts: DataFrame, rules: DataFrame, host_col: str = "host") -> DataFrame:
    """(host, public_suffix, domain) of the distinct hosts, by rules (rule): ``co.jp``, ``*.ck`` and ``!www.ck``.

    An exception goes before all other rules, then the rule with most labels; a host that none fits has its last label as
    suffix. Hosts under .uk always have two labels. Addresses and single labels have no suffix and are their own domain.
    """
    host = F.col("host")
    base = hosts.select(F.lower(host_col).alias("host")).where("host is not null").distinct()
    level = base.select("host", F.explode(urls.host_levels(host)).alias("level"))
    n = F.size(F.split("level", r"\."))
    kinds = F.array(
        F.struct(F.col("level").alias("rule"), n.alias("n"), F.lit(0).alias("first")),
        F.struct(F.concat(F.lit("*."), F.expr("substring(level, instr(level, '.') + 1)")).alias("rule"), n.alias("n"), F.lit(0).alias("first")),
        F.struct(F.concat(F.lit("!"), F.col("level")).alias("rule"), (n - 1).alias("n"), F.lit(1).alias("first")),
    )
    candidates = level.select("host", F.explode(kinds).alias("c")).select("host", "c.*")
    known = rules.select("rule").distinct()
    known = F.broadcast(known) if known.count() <= SMALL else known
    best = candidates.join(known, "rule").groupBy("host").agg(F.max(F.struct("first", "n")).alias("b")).select("host", "b.n")
    labels = urls.labels(host)
    count = F.when(F.size(labels) < 2, None).when(F.element_at(labels, -1) == "uk", 2).otherwise(F.coalesce("n", F.lit(1)))
    out = base.join(best, "host", "left").select("host", count.alias("n"))
    last = lambda k: F.when(F.size(labels) >= k, F.array_join(F.slice(labels, F.greatest(F.size(labels) - k + 1, F.lit(1)), k), "."))
    return out.select("host", last(F.col("n")).alias("public_suffix"), F.coalesce(last(F.col("n") + 1), host).alias("domain"))
