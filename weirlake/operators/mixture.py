"""A mixture of sources and domains: weights of domains, caps of domains and sources, an exact seeded choice of documents."""

from __future__ import annotations

from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirlake.operators.sampling import hash_key, within
from weirlake.operators.staging import staged_at

MILLION = 1_000_000


@dataclass
class Mixture:
    """Weights of domains (whole numbers; others have ``weight``) and greatest shares in millionths of the budget."""

    budget: int
    weight: int = 1
    weights: dict[str, int] = field(default_factory=dict)
    domain_caps: dict[str, int] = field(default_factory=dict)
    source_caps: dict[str, int] = field(default_factory=dict)
    domain_cap: int = MILLION
    source_cap: int = MILLION
    seed: int = 0


def _looked_up(name: Column, known: dict[str, int], other: int) -> Column:
    out = F.lit(other).cast("long")
    for value, number in known.items():
        out = F.when(name.eqNullSafe(F.lit(value)), F.lit(number).cast("long")).otherwise(out)
    return out


def water_filled(groups: DataFrame, budget: int) -> DataFrame:
    """``groups`` (most, weight: whole numbers) with ``quota``: the budget by weight, none above its ``most``.

    Groups that their part would put above their limit get the limit and the others share what is left, round by round,
    until no more are clamped; a round is one small aggregation. Parts are whole, rounded down, and compared exactly.
    """
    weights = groups.agg(F.coalesce(F.sum("weight"), F.lit(0))).first()[0]
    left = budget

    def over() -> Column:
        return F.col("most").cast("decimal(19,0)") * F.lit(Decimal(weights)).cast("decimal(18,0)") <= F.lit(Decimal(max(left, 0))).cast("decimal(19,0)") * F.col("weight").cast("decimal(18,0)")

    while weights:
        taken, still = groups.agg(F.coalesce(F.sum(F.when(over(), F.col("most"))), F.lit(0)), F.coalesce(F.sum(F.when(~over(), F.col("weight"))), F.lit(0))).first()
        if still == weights:
            break
        left, weights = budget - taken, still
    if not weights:
        return groups.withColumn("quota", F.col("most"))
    part = F.call_function("div", F.lit(Decimal(left)).cast("decimal(19,0)") * F.col("weight").cast("decimal(18,0)"), F.lit(Decimal(weights)).cast("decimal(18,0)"))
    return groups.withColumn("quota", F.when(over(), F.col("most")).otherwise(F.least("most", part)))


def quotas(groups: DataFrame, plan: Mixture) -> DataFrame:
    """(domain, source, amount, quota) of groups (domain, source, amount): what the mixture may take of each.

    A source is held to its cap over all its domains, by the share of each; a domain to its cap; then the budget is shared
    among domains by weight up to what is left of them (``water_filled``), and a domain's part among its groups in proportion.
    Every step only lowers, and rounds down, so all caps hold exactly.
    """
    whole = lambda a, b, c: F.call_function("div", a.cast("decimal(19,0)") * b.cast("decimal(18,0)"), c.cast("decimal(19,0)"))
    cap = lambda name, known, other: whole(_looked_up(F.col(name), known, other), F.lit(plan.budget), F.lit(MILLION))
    of_source = groups.groupBy("source").agg(F.sum("amount").alias("_all")).withColumn("_cap", cap("source", plan.source_caps, plan.source_cap))
    own = groups.join(of_source.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).select(
        "domain", "source", "amount", F.when(F.col("_all") <= F.col("_cap"), F.col("amount")).otherwise(whole(F.col("amount"), F.col("_cap"), F.greatest("_all", F.lit(1)))).alias("open")
    )
    domains = own.groupBy("domain").agg(F.sum("open").alias("_open")).withColumn("most", F.least("_open", cap("domain", plan.domain_caps, plan.domain_cap)))
    domains, _ = staged_at(domains.withColumn("weight", _looked_up(F.col("domain"), plan.weights, plan.weight)), "domains")
    filled = water_filled(domains, plan.budget).select(F.col("domain").alias("_d"), "_open", F.col("quota").alias("_quota"))
    part = F.when(F.col("_quota") >= F.col("_open"), F.col("open")).otherwise(whole(F.col("open"), F.col("_quota"), F.greatest("_open", F.lit(1))))
    return own.join(filled, F.col("domain").eqNullSafe(F.col("_d"))).select("domain", "source", "amount", part.alias("quota"))


def _group_id() -> Column:
    part = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit(""))
    return F.sha2(F.concat(F.char_length(part("domain")).cast("string"), part("domain"), part("source")), 256)


def mixed(docs: DataFrame, plan: Mixture, domain: Column, source: Column, amount: Column, *identity: Column) -> tuple[DataFrame, DataFrame]:
    """(chosen, report): ``docs`` of the mixture with domain, source and amount, and what was taken of each group.

    Documents are taken without replacement in the order of a seeded hash of ``identity``, so reruns agree, until the
    next one would not fit its group's quota. Null domains and sources are groups like others; documents of no
    amount are kept as long as their group is. The report has a row a group: documents and amounts there and taken, the
    quota, the share of all that was taken.
    """
    named = ("domain", "source", "amount", "key")
    keyed, _ = staged_at(docs.select(*(F.col(c) for c in docs.columns if c not in named), domain.cast("string").alias("domain"), source.cast("string").alias("source"), F.coalesce(amount.cast("long"), F.lit(0)).alias("amount"), hash_key(plan.seed, *identity).alias("key")), "mixture")
    groups, _ = staged_at(keyed.groupBy("domain", "source").agg(F.count(F.lit(1)).alias("documents"), F.sum("amount").alias("amount")), "groups")
    quota = staged_at(quotas(groups, plan).select(_group_id().alias("group_id"), "quota"), "quotas")[0]
    chosen, _ = staged_at(within(keyed.withColumn("group_id", _group_id()), quota).drop("key"), "chosen")
    taken = chosen.groupBy("group_id").agg(F.count(F.lit(1)).alias("taken_documents"), F.sum("amount").alias("taken_amount"))
    all_ = chosen.agg(F.coalesce(F.sum("amount"), F.lit(0)).alias("_all"))
    report = groups.withColumn("group_id", _group_id()).join(quota, "group_id").join(taken, "group_id", "left").crossJoin(F.broadcast(all_)).select(
        "domain", "source", "documents", "amount", "quota", F.coalesce("taken_documents", F.lit(0)).alias("taken_documents"), F.coalesce("taken_amount", F.lit(0)).alias("taken_amount"),
        F.round(F.coalesce(F.col("taken_amount") / F.when(F.col("_all") > 0, F.col("_all")), F.lit(0.0)), 6).alias("share"),
    )
    return chosen.drop("group_id"), report
