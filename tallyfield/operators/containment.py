"""Which names contain which, by an inverted index of q-grams.

The longer names ("hays") are indexed by their grams with places: as many rows as letters, however
long they are. A shorter name ("needle") is looked up by one gram only, the one with the fewest
entries of its position code; a needle with a gram that no hay has is gone before that. Where the
needle would begin follows from the two places, so lengths are checked in the index already, and the
text is compared at that one place. A needle shorter than a gram is looked up as it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Letters of a gram.
GRAM = 3


def _grams(size: str) -> str:
    """SQL: structs of each gram of a size and its place in name_key."""
    return (
        f"transform(sequence(1, length(name_key) - {size} + 1), "
        f"at -> struct(substring(name_key, at, {size}) AS gram, at AS place))"
    )


def index_of(hays: DataFrame, needles: DataFrame) -> DataFrame:
    """(pos_key, hay, letters, gram, place) for the gram sizes that some needle asks for."""
    sizes = needles.agg(F.collect_set(F.least(F.length("name_key"), F.lit(GRAM)))).scalar()
    grams = F.expr(
        f"explode(flatten(transform(filter(_sizes, n -> n > 0 AND n <= length(name_key)), n -> {_grams('n')})))"
    )
    return hays.withColumn("_sizes", sizes).select(
        "pos_key", hay_id().alias("hay"), F.length("name_key").alias("letters"), grams.alias("_g")
    ).select("pos_key", "hay", "letters", "_g.gram", "_g.place")


def hay_id() -> Column:
    """A number for a name; names that share one are told apart when texts are compared."""
    return F.xxhash64("name_key")


def rarest_grams(needles: DataFrame, index: DataFrame) -> DataFrame:
    """Each needle that may be found, with its least frequent gram and that gram's place."""
    entries = index.groupBy("pos_key", "gram").agg(F.count(F.lit(1)).alias("n"))
    asked = needles.where(F.col("name_key") != "").select(
        *needles.columns, F.explode(F.expr(_grams(f"least({GRAM}, length(name_key))"))).alias("_g")
    )
    known = asked.select(*needles.columns, "_g.gram", "_g.place").join(entries, ["pos_key", "gram"], "left")
    least = F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram", "place")).alias("_rare")
    return known.groupBy(*needles.columns).agg(least).where("_rare.n > 0").select(*needles.columns, "_rare.gram", "_rare.place")


def containing(needles: DataFrame, hays: DataFrame) -> DataFrame:
    """(pos_key, needle, hay) and both sides' ids, for each needle inside a hay of its position code.

    Both frames have name_key, pos_key, and may have player_id; needles without letters are left out.
    Joins are pinned to sort-merge: an index is much larger than the names it is estimated from, and
    adaptive execution splits a gram that very many names share.
    """
    index = index_of(hays, needles)
    looked = rarest_grams(needles, index).withColumnsRenamed({"name_key": "needle", "place": "_at", "player_id": "needle_id"})
    begins = F.col("place") - F.col("_at") + 1
    hits = (
        looked.hint("merge").join(index, ["pos_key", "gram"])
        .where((begins >= 1) & (begins + F.length("needle") - 1 <= F.col("letters")))
        .select(*[c for c in looked.columns if c not in ("gram", "_at")], "hay", begins.alias("begin"))
    )
    texts = hays.withColumn("hay", hay_id()).withColumnsRenamed({"name_key": "_text", "player_id": "hay_id"})
    found = hits.hint("merge").join(texts, ["pos_key", "hay"])
    there = F.substring(F.col("_text"), F.col("begin"), F.length("needle")) == F.col("needle")
    return found.where(there).drop("hay", "begin").withColumnRenamed("_text", "hay")
