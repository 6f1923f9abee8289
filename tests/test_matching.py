import random

from tallyfield.operators import matching
from tallyfield.plans import ranks


def raw_rows(spark, people, extra=()):
    rows = [
        (2015, False, name, pos, float(i), 1.0, 2.0, None, None, None, None, i)
        for i, (name, pos) in enumerate(people)
    ] + list(extra)
    return spark.createDataFrame(
        rows,
        "year int, before_preseason boolean, player_name string, position string, rank double, best_rank double, "
        "worst_rank double, avg_rank double, stddev_rank double, adp double, vs_adp double, position_rank bigint",
    )


def roster_rows(spark, people):
    return spark.createDataFrame(people, "player_id string, player_name string, position string")


def brute(raw, roster):
    """name, position -> (id, kind) by comparing every pair."""
    out = {}
    for name, pos in raw:
        if name is None or pos is None:
            continue
        n, p = name.strip(" ").lower(), pos.strip(" ").upper()
        same = [(i, r.strip(" ").lower()) for i, r, q in roster if r is not None and q is not None and q.strip(" ").upper() == p]
        exact = [i for i, r in same if r == n]
        bare = lambda s: s.replace(".", "").replace(" ", "")
        partial = [i for i, r in same if bare(r) == bare(n) or r in n or n in r]
        hits, kind = (exact, "exact_match") if exact else (partial, "partial_match")
        if hits:
            ids = [i for i in hits if i is not None]
            out[(name, pos)] = (min(ids) if ids else None, kind)
    return out


def linked(spark, people, roster):
    df = matching.link_players(raw_rows(spark, people), roster_rows(spark, roster))
    return {(r.player_name, r.position): (r.player_id, r.match_type) for r in df.collect()}


PEOPLE = [
    ("B.J. Blue", "WR"), ("hugo james ", "wr"), ("Otto Beck Jr.", "WR"), ("Aaron", "RB"), ("Nobody Here", "QB"),
    ("Mike", None), ("Some Town Team", "DST"), ("Twin", "TE"),
]
ROSTER = [
    ("1", "BJ Blue", "WR"), ("2", "Hugo James", "WR"), ("9", "Hugo James", "WR"), ("3", "Otto Beck", "WR"),
    ("4", "Aaron Pater", "RB"), ("5", "Mike", "WR"), (None, "Twin", "TE"), ("8", "Twins", "TE"), ("7", None, "RB"),
]


def test_each_way_of_matching(spark):
    got = linked(spark, PEOPLE, ROSTER)
    assert got == brute(PEOPLE, ROSTER)
    assert got[("B.J. Blue", "WR")] == ("1", "partial_match")
    assert got[("hugo james ", "wr")] == ("2", "exact_match")
    assert got[("Otto Beck Jr.", "WR")] == ("3", "partial_match")
    assert got[("Aaron", "RB")] == ("4", "partial_match")
    # an exact match without an id still hides the partial one
    assert got[("Twin", "TE")] == (None, "exact_match")
    assert ("Nobody Here", "QB") not in got and ("Mike", None) not in got


def test_blank_names(spark):
    people = [("x y", "QB"), ("", "RB"), ("zz", "RB")]
    roster = [("1", " ", "QB"), ("2", "Al", "RB"), ("1", "Bo", "RB")]
    assert linked(spark, people, roster) == brute(people, roster)


def test_random_names_against_brute_force(spark):
    rnd = random.Random(11)
    word = lambda: "".join(rnd.choice("ab. ") for _ in range(rnd.randrange(1, 7)))
    people = list({(word(), rnd.choice(["QB", "rb", " WR"])) for _ in range(150)})
    roster = [(str(rnd.randrange(1000)) if rnd.random() > 0.1 else None, word(), rnd.choice(["QB", "RB", "WR "])) for _ in range(120)]
    assert linked(spark, people, roster) == brute(people, roster)


def test_repeated_entries_collapse(spark):
    again = (2015, False, "B.J. Blue", "WR", 0.0, 0.5, 2.0, None, None, None, None, 0)
    df = matching.link_players(raw_rows(spark, PEOPLE[:1], [again]), roster_rows(spark, ROSTER))
    assert [(r.player_id, r.best_rank) for r in df.collect()] == [("1", 0.5)]


def test_report_and_unmatched(spark):
    raw, rosters = raw_rows(spark, PEOPLE), roster_rows(spark, ROSTER)
    table = ranks.linked_rankings(raw, rosters)
    assert table.columns == list(ranks.LINKED_COLUMNS)
    r = ranks.match_report(raw, table).first()
    assert (r.total_raw_records, r.total_matched_records, r.unmatched_count, r.match_rate) == (8, 5, 3, 62.5)
    names = {x.player_name for x in ranks.unmatched_names(raw, table).collect()}
    assert names == {"Nobody Here", "Mike", "Some Town Team", "Twin"}
    assert {x["match_type"]: x["count"] for x in ranks.match_types(table, rosters).collect()} == {
        "exact_match": 2, "partial_match": 3,
    }
    assert ranks.match_report(raw.limit(0), table.limit(0)).first().match_rate is None
