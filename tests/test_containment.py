"""The gram index against comparing every pair."""

import random

import pytest

from tallyfield.operators import containment

SCHEMA = "name_key string, pos_key string, player_id string"


def frame(spark, names, ids="p"):
    return spark.createDataFrame([(n, p, f"{ids}{i}") for i, (n, p) in enumerate(names)], SCHEMA)


def pairs(spark, needles, hays):
    found = containment.containing(frame(spark, needles, "n"), frame(spark, hays, "h")).collect()
    return sorted({(r["needle"], r["hay"], r["pos_key"], r["needle_id"], r["hay_id"]) for r in found})


def plain(needles, hays):
    return sorted({
        (n, h, p, f"n{i}", f"h{j}") for i, (n, p) in enumerate(needles) for j, (h, q) in enumerate(hays) if p == q and n and n in h
    })


def names(seed, many, letters, longest):
    draw = random.Random(seed)
    made = {("".join(draw.choice(letters) for _ in range(draw.randrange(longest))), draw.choice(["QB", "RB"])) for _ in range(many)}
    return sorted(made)


@pytest.mark.parametrize("letters,longest", [("ab", 9), ("abcdé 日", 14), ("a", 12), ("%_\\.a", 8)])
def test_every_pair(spark, letters, longest):
    needles, hays = names(1, 120, letters, longest // 2 + 1), names(2, 150, letters, longest)
    assert pairs(spark, needles, hays) == plain(needles, hays)


def test_long_names(spark):
    draw = random.Random(4)
    hays = [("".join(draw.choice("abc") for _ in range(2000)), "QB") for _ in range(6)]
    needles = [(h[at : at + n], "QB") for h, _ in hays for at, n in ((0, 2000), (3, 1500), (1997, 3), (900, 40))]
    needles += [("x" + hays[0][0], "QB"), (hays[0][0] + "a", "QB"), (hays[1][0][:800] + "zz", "QB")]
    assert pairs(spark, needles, hays) == plain(needles, hays)
    index = containment.index_of(frame(spark, hays), frame(spark, needles))
    assert index.count() == 6 * (2000 - containment.GRAM + 1)  # one row a letter, not one a substring


def test_a_common_gram_is_not_the_one_looked_up(spark):
    hays = [(f"son{i:03d}", "QB") for i in range(300)]
    needles = [("son017", "QB"), ("son", "QB"), ("sonx", "QB"), ("qqq", "QB")]
    index = containment.index_of(frame(spark, hays), frame(spark, needles))
    chosen = {r["name_key"]: r["gram"] for r in containment.rarest_grams(frame(spark, needles), index).collect()}
    assert chosen == {"son017": "017", "son": "son"}  # the others hold a gram that nothing has
    assert pairs(spark, needles, hays) == plain(needles, hays)


def test_nothing_and_blank(spark):
    assert pairs(spark, [], [("a", "QB")]) == [] and pairs(spark, [("a", "QB")], []) == []
    assert pairs(spark, [("", "QB")], [("abc", "QB"), ("", "QB")]) == []
