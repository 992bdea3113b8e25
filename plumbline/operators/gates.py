"""Data-quality gates: each is a scalar and a predicate over it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Gate:
    name: str
    rows: DataFrame
    value: Column
    operator: str
    bound: float

    def checked(self) -> DataFrame:
        v = F.coalesce(self.value.cast("double"), F.lit(0.0))
        return self.rows.agg(v.alias("value")).select(F.lit(self.name).alias("gate"), F.round("value", 4).alias("value"), F.expr(f"value {self.operator} {self.bound}").alias("passed"))


def percent(condition: Column) -> Column:
    return F.try_divide(100.0 * F.count_if(condition), F.count("*"))


def checked(gates: list[Gate]) -> DataFrame:
    """One row per gate."""
    out = gates[0].checked()
    for g in gates[1:]:
        out = out.unionByName(g.checked())
    return out


def standard_gates(facts: DataFrame, parties: DataFrame, parsed: DataFrame, decisions: DataFrame, organizations: DataFrame, aliases: DataFrame) -> list[Gate]:
    """The ten gates. ``facts``: node_id, org_id, program_id, country_id, level; ``parties``: node_id; ``parsed``: complete; ``decisions``: loser_key, winner_key, decision."""
    merges = decisions.where("decision = 'merge'")
    orphans = parties.join(facts.select("node_id"), "node_id", "left_anti")
    winners = merges.join(organizations.select(F.col("norm_key").alias("winner_key")), "winner_key", "left_anti")
    losers = merges.join(aliases.select(F.col("alias_key").alias("loser_key")), "loser_key", "left_anti")
    n = F.count("*")
    return [
        Gate("no duplicate node_ids", facts, n - F.countDistinct("node_id"), "=", 0),
        Gate("no recognitions without an entrant", facts, F.count_if(F.col("org_id").isNull()), "=", 0),
        Gate("no orphan parties", orphans, n, "=", 0),
        Gate("program coverage", facts, percent(F.col("program_id").isNotNull()), ">", 99),
        Gate("organization coverage", facts, percent(F.col("org_id").isNotNull()), ">", 99),
        Gate("country coverage", facts, percent(F.col("country_id").isNotNull()), ">", 98),
        Gate("level known", facts, percent(F.col("level") != "other"), ">", 95),
        Gate("parse completeness", parsed, percent(F.col("complete")), ">", 99),
        Gate("no orphaned merge winners", winners, n, "=", 0),
        Gate("alias covers all merge losers", losers, n, "=", 0),
    ]


def harvest_gates(queue: DataFrame, reported: int) -> list[Gate]:
    return [Gate("queue is not empty", queue, F.count("*"), ">", 0), Gate("all reported ids queued", queue, F.countDistinct("node_id"), ">=", reported), Gate("no duplicate ids", queue, F.count("*") - F.countDistinct("node_id"), "=", 0)]


def fetch_gates(queue: DataFrame, reported: int) -> list[Gate]:
    of = lambda s: F.count_if(F.col("status") == s)
    return [Gate("nothing pending", queue, of("pending"), "=", 0), Gate("nothing in flight", queue, of("fetching"), "=", 0), Gate("nothing failed", queue, of("failed"), "=", 0), Gate("fetched all reported", queue, of("done"), ">=", reported)]
