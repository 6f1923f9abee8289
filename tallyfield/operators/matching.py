"""Linking ranked names to player ids: exact first, then partial.

A ranked name matches a roster name of the same position when, after trimming and lowering,
the two are equal (exact), or else equal without dots and spaces, or one contains the other
(partial).  Of several ids the smallest is kept.

Names repeat over years and weeks, so all matching runs on distinct (name, position) pairs;
each roster pair already carries its smallest id.  Containment goes through an index of
q-grams (``containment``): a pair is compared only where its rarest gram says it may match.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfield.functions.names import bare_key, name_key, position_key
from tallyfield.operators.containment import containing
from tallyfield.session import stored

EXACT, PARTIAL = "exact_match", "partial_match"

#: A ranking entry; rows agreeing on these are one entry.
ENTRY_KEY = ("year", "before_preseason", "player_name", "position", "rank")


def roster_names(rosters: DataFrame) -> DataFrame:
    """Distinct (name_key, pos_key) of the roster, each with its smallest player id."""
    return (
        rosters.select(
            name_key(F.col("player_name")).alias("name_key"),
            position_key(F.col("position")).alias("pos_key"),
            "player_id",
        )
        .where(F.col("name_key").isNotNull() & F.col("pos_key").isNotNull())
        .groupBy("name_key", "pos_key")
        .agg(F.min("player_id").alias("player_id"))
    )


def ranked_names(raw: DataFrame) -> DataFrame:
    """Distinct (name_key, pos_key) of the rankings."""
    return (
        raw.select(
            name_key(F.col("player_name")).alias("name_key"),
            position_key(F.col("position")).alias("pos_key"),
        )
        .where(F.col("name_key").isNotNull() & F.col("pos_key").isNotNull())
        .distinct()
    )


def _looked_up(names: DataFrame, roster: DataFrame) -> DataFrame:
    """Names with ``found``: a struct holding the player id, NULL if the name is not there.

    Exact matches and the rest both come out of this one join.  The struct tells "found, but
    without an id" from "not found", and keeps both users on the same shuffled roster.
    """
    there = roster.select("name_key", "pos_key", F.struct("player_id").alias("found"))
    return names.join(there, ["name_key", "pos_key"], "left")


def exact_matches(names: DataFrame, roster: DataFrame) -> DataFrame:
    """Names found as they are: (name_key, pos_key, player_id)."""
    hits = _looked_up(names, roster).where(F.col("found").isNotNull())
    return hits.select("name_key", "pos_key", "found.player_id")


def not_exact(names: DataFrame, roster: DataFrame) -> DataFrame:
    """Names without an exact match."""
    return _looked_up(names, roster).where(F.col("found").isNull()).select("name_key", "pos_key")


def partial_matches(names: DataFrame, roster: DataFrame) -> DataFrame:
    """Names found without dots and spaces or by containment: (name_key, pos_key, player_id)."""
    out = ["name_key", "pos_key", "player_id"]

    def smallest(df: DataFrame, *keys: str) -> DataFrame:
        return df.groupBy(*keys).agg(F.min("player_id").alias("player_id"))

    bare = names.withColumn("bare", bare_key(F.col("name_key"))).join(
        smallest(roster.withColumn("bare", bare_key(F.col("name_key"))), "bare", "pos_key"), ["bare", "pos_key"]
    )
    holds_roster = containing(roster, names).select(F.col("hay").alias("name_key"), "pos_key", F.col("needle_id").alias("player_id"))
    in_roster = containing(names, roster).select(F.col("needle").alias("name_key"), "pos_key", F.col("hay_id").alias("player_id"))
    # A blank name is contained in every name of its position, as LIKE '%%' has it.
    blank = F.col("name_key") == ""
    holds_blank = names.join(smallest(roster.where(blank), "pos_key"), "pos_key")
    blank_names = names.where(blank).join(smallest(roster, "pos_key"), "pos_key")

    found = bare.select(out)
    for part in (holds_roster, in_roster, holds_blank, blank_names):
        found = found.unionByName(part.select(out))
    return smallest(found, "name_key", "pos_key")


def resolve_names(raw: DataFrame, rosters: DataFrame) -> DataFrame:
    """(name_key, pos_key, player_id, match_type) for every ranked name that has a match."""
    # Both are small beside their sources, and are read by every way of matching.
    names, roster = stored(ranked_names(raw)), stored(roster_names(rosters))
    exact = exact_matches(names, roster)
    partial = partial_matches(stored(not_exact(names, roster)), roster)
    return exact.withColumn("match_type", F.lit(EXACT)).unionByName(
        partial.withColumn("match_type", F.lit(PARTIAL))
    )


def link_players(raw: DataFrame, rosters: DataFrame) -> DataFrame:
    """Ranking entries with a player id and how it was found; unmatched entries are left out.

    Entries repeated in ``raw`` collapse to one: the smallest by its remaining columns.
    """
    rest = [c for c in raw.columns if c not in ENTRY_KEY]
    entries = raw.groupBy(*ENTRY_KEY).agg(F.min(F.struct(*rest)).alias("_rest"))
    keyed = entries.select(
        *ENTRY_KEY, "_rest.*",
        name_key(F.col("player_name")).alias("name_key"),
        position_key(F.col("position")).alias("pos_key"),
    )
    return keyed.join(resolve_names(raw, rosters), ["name_key", "pos_key"]).select(
        *raw.columns, "player_id", "match_type"
    )


def unmatched_entries(raw: DataFrame, linked: DataFrame) -> DataFrame:
    """Raw rows without a linked id (a NULL in the entry key never matches)."""
    with_id = linked.where(F.col("player_id").isNotNull()).select(*ENTRY_KEY).distinct()
    return raw.join(with_id, list(ENTRY_KEY), "left_anti")
