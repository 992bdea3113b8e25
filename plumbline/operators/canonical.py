"""Canonical entities: dimensions, slugs, merge closure, aliases, ledger."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.text import slug_of_key
from plumbline.session import cut


def dimension(rows: DataFrame, key: Column, name: Column, order: Column) -> DataFrame:
    """Distinct keys with the name seen first and a unique slug."""
    seen = rows.select(key.alias("norm_key"), name.alias("name"), order.alias("seq")).where("norm_key <> ''")
    first = seen.groupBy("norm_key").agg(F.min_by("name", "seq").alias("name"), F.min("seq").alias("first_seq"), F.count("*").alias("n_rows"))
    return with_slugs(first)


def with_slugs(entities: DataFrame) -> DataFrame:
    """Unique slugs: the base for the first seen, then ``-2``, ``-3``...

    Every base belongs to its first entity, so numbers that would give another entity's base are passed over: the
    k-th later entity of a base gets its k-th free number. Suffixed slugs of different bases cannot meet.
    """
    df = entities.withColumn("_base", slug_of_key(F.col("norm_key"))).withColumn("_n", F.row_number().over(Window.partitionBy("_base").orderBy("first_seq", "norm_key")))
    ends = df.where("_n = 1").select(F.regexp_extract("_base", r"^(.+)-([1-9]\d{0,17})$", 1).alias("_base"), F.regexp_extract("_base", r"^(.+)-([1-9]\d{0,17})$", 2).try_cast("bigint").alias("_taken"))
    taken = ends.where("_taken >= 2").groupBy("_base").agg(F.array_sort(F.collect_set("_taken")).alias("_taken"))
    passed = F.size(F.filter(F.coalesce("_taken", F.array().cast("array<bigint>")), lambda t, i: t - i <= F.col("_n")))
    slug = F.when(F.col("_n") == 1, F.col("_base")).otherwise(F.concat_ws("-", "_base", (F.col("_n") + passed).cast("string")))
    return df.join(taken, "_base", "left").withColumn("slug", slug).drop("_base", "_n", "_taken")


def merge_closure(decisions: DataFrame) -> DataFrame:
    """Each losing key with the key at the end of its chain (``loser_key``, ``winner_key``; one winner each, the smallest of several).

    A walk that meets a cycle ends at the first key of the cycle; keys of a cycle end at themselves. Pointers are doubled, so the
    rounds grow with the logarithm of the longest chain. Decisions with a null key are left out.
    """
    edges = decisions.where("loser_key IS NOT NULL AND winner_key IS NOT NULL").groupBy("loser_key").agg(F.min("winner_key").alias("winner_key"))
    done, rest = _doubled(edges)
    # What walks on after as many steps as there are keys has reached a cycle, and stands on every key of it.
    while not rest.isEmpty():
        cycle = rest.select(F.col("at").alias("loser_key")).distinct()
        entering = edges.join(rest.select("loser_key"), "loser_key", "left_semi").join(cycle, "loser_key", "left_anti")
        done = done.union(cycle.select("loser_key", F.col("loser_key").alias("at")))
        more, rest = _doubled(entering)
        done = done.union(more)
    return done.select("loser_key", F.col("at").alias("canonical_key"))


def _doubled(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(key, end) of the walks that end, and (key, where it stands) of those that have taken more steps than there are keys."""
    walk = cut(edges.select("loser_key", F.col("winner_key").alias("at")))
    done, steps = None, 1
    while True:
        n = walk.count()
        ahead = walk.select(F.col("loser_key").alias("at"), F.col("at").alias("to"))
        ended = walk.join(ahead, "at", "left_anti").select("loser_key", "at")
        if done is not None:  # keys whose next stop has ended meanwhile end where it does
            ended = ended.join(done.select(F.col("loser_key").alias("at"), F.col("at").alias("end")), "at", "left").select("loser_key", F.coalesce("end", "at").alias("at"))
        done = cut(ended if done is None else done.union(ended))
        walk = cut(walk.join(ahead, "at").select("loser_key", F.col("to").alias("at")))
        steps *= 2
        if n == 0 or steps > 2 * n:
            return done, walk


def resolved(rows: DataFrame, closure: DataFrame, key: str) -> DataFrame:
    """``rows`` with ``canonical_key``: the end of the key's chain, or the key."""
    return rows.join(closure.withColumnRenamed("loser_key", key), key, "left").withColumn("canonical_key", F.coalesce("canonical_key", key))


def aliases(closure: DataFrame, organizations: DataFrame) -> DataFrame:
    """Aliases of organisations that exist, from losing keys."""
    return closure.join(organizations.select(F.col("norm_key").alias("canonical_key"), "slug"), "canonical_key").select(F.col("loser_key").alias("alias_key"), "canonical_key", "slug")


def ledger(rows: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """Match ledger: a row per recognition and linked dimension. ``kinds``: entity type by id column."""
    pairs = F.array(*(F.struct(F.lit(kind).alias("entity_type"), F.col(c).cast("string").alias("entity_id")) for c, kind in kinds.items()))
    return rows.select("node_id", F.explode(pairs).alias("e")).where("e.entity_id is not null").select("node_id", "e.entity_type", "e.entity_id")


def chosen_winner(a: Column, n_a: Column, b: Column, n_b: Column) -> tuple[Column, Column]:
    """(winner, loser) of a merge: more recognitions win, ties go left."""
    return F.when(n_b > n_a, b).otherwise(a), F.when(n_b > n_a, a).otherwise(b)
