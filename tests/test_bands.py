import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tallyfield.operators.bands import around
from tallyfield.plans.queries import injury_days

DAY = dt.timedelta(days=1)


def brute(facts, events, before, after):
    """(key, at) -> events, facts and sum before, facts and sum after; all pairs looked at."""
    out = {}
    for key, at in events:
        if key is None or at is None:
            continue
        if (key, at) in out:
            out[key, at][0] += 1
            continue
        pre = [v for k, t, v in facts if k == key and t is not None and at - before <= t < at]
        post = [v for k, t, v in facts if k == key and t is not None and at < t <= at + after]
        out[key, at] = [1, len(pre), sum(v or 0 for v in pre), len(post), sum(v or 0 for v in post)]
    return out


def result(df):
    return {(r["k"], r["at"]): [r["events"], r["facts_before"], r["v_before"], r["facts_after"], r["v_after"]] for r in df.collect()}


def frames(spark, facts, events, kind="date"):
    return spark.createDataFrame(facts, f"k string, at {kind}, v int"), spark.createDataFrame(events, f"k string, at {kind}")


@pytest.mark.parametrize("buckets", [1, 2, 7, 128])
def test_days_of_a_hot_key_equal_all_pairs(spark, buckets):
    rng, first = random.Random(buckets), dt.date(2023, 1, 1)
    keys = ["hot"] * 6 + ["a", "b", "c", None]
    facts = [(rng.choice(keys), first + rng.randrange(200) * DAY, rng.choice([None, -3, 0, 5, 40])) for _ in range(600)]
    events = [(rng.choice([*keys, "unknown"]), first + rng.randrange(-20, 230) * DAY) for _ in range(150)]
    facts += [("a", None, 1)]
    events += [("a", None)]
    got = around(*frames(spark, facts, events), ["k"], "at", ["v"], 14 * DAY, 30 * DAY, buckets=buckets)
    assert result(got) == brute(facts, events, 14 * DAY, 30 * DAY)


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_timestamps_to_the_microsecond(spark, kind):
    at, tick, hour = dt.datetime(2023, 3, 26, 2, 30), dt.timedelta(microseconds=1), dt.timedelta(hours=1)
    facts = [("a", at + d, 1) for d in (-hour - tick, -hour, -tick, 0 * tick, tick, hour, hour + tick)]
    events = [("a", at), ("a", at), ("a", at + hour)]
    got = around(*frames(spark, facts, events, kind), ["k"], "at", ["v"], hour, hour)
    want = brute(facts, events, hour, hour)
    assert want["a", at] == [2, 2, 2, 2, 2]
    assert result(got) == want


def test_empty_sides_and_no_length(spark):
    facts, events = [("a", dt.date(2023, 1, 1), 5)], [("a", dt.date(2023, 1, 1)), ("a", dt.date(2023, 1, 2))]
    f, e = frames(spark, facts, events)
    assert result(around(f, e.limit(0), ["k"], "at", ["v"], DAY, DAY)) == {}
    assert result(around(f.limit(0), e, ["k"], "at", ["v"], DAY, DAY)) == {(k, a): [1, 0, 0, 0, 0] for k, a in events}
    assert result(around(f, e, ["k"], "at", ["v"], 0 * DAY, 0 * DAY)) == {(k, a): [1, 0, 0, 0, 0] for k, a in events}


def test_lengths_and_types_that_do_not_fit(spark):
    f, e = frames(spark, [("a", dt.date(2023, 1, 1), 5)], [("a", dt.date(2023, 1, 1))])
    with pytest.raises(ValueError, match="whole length"):
        around(f, e, ["k"], "at", ["v"], dt.timedelta(hours=1), DAY)
    with pytest.raises(ValueError, match="whole length"):
        around(f, e, ["k"], "at", ["v"], -DAY, DAY)
    with pytest.raises(ValueError, match="timestamp in facts"):
        around(f.withColumn("at", F.col("at").cast("timestamp")), e, ["k"], "at", ["v"], DAY, DAY)


def test_several_keys_and_names_of_its_own(spark):
    at = dt.date(2023, 1, 5)
    facts = spark.createDataFrame([("a", 1, at - DAY, 2, 3), ("a", 2, at - DAY, 5, 7)], "_v string, _k0 int, _at date, _n int, _place int")
    events = spark.createDataFrame([("a", 1, at), ("a", 2, at)], "_v string, _k0 int, _at date")
    out = around(facts, events, ["_v", "_k0"], "_at", ["_n", "_place"], DAY, DAY)
    assert out.columns == ["_v", "_k0", "_at", "events", "facts_before", "_n_before", "_place_before", "facts_after", "_n_after", "_place_after"]
    assert sorted(tuple(r) for r in out.collect()) == [("a", 1, at, 1, 1, 2, 3, 0, 0, 0), ("a", 2, at, 1, 1, 5, 7, 0, 0, 0)]


def test_no_pair_is_made(spark):
    """One key, as many events as facts: rows through any operator stay a small multiple of the input."""
    facts = spark.range(3000).selectExpr("'a' AS k", "date_add(date'2020-01-01', int(id % 1500)) AS at", "1 AS v")
    events = facts.select("k", "at")
    out = around(facts, events, ["k"], "at", ["v"], 100 * DAY, 100 * DAY)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
    got = {r["at"]: (r["events"], r["facts_before"], r["facts_after"]) for r in out.collect()}
    assert len(got) == 1500
    assert all(got[dt.date(2020, 1, 1) + i * DAY] == (2, 2 * min(i, 100), 2 * min(1499 - i, 100)) for i in range(1500))


def test_injury_days(spark):
    day = dt.date(2023, 9, 10)
    games = spark.createDataFrame(
        [("p", day - 7 * DAY, 10.1), ("p", day - DAY, 20.2), ("p", day, 99.0), ("p", day + 7 * DAY, None), ("p", day + 8 * DAY, 5.5)],
        "player_name string, game_date date, fantasy_points_std double",
    )
    hurt = spark.createDataFrame(
        [("p", day, "Out"), ("p", day, "Healthy"), ("p", day + 60 * DAY, "Out"), ("q", day, "Out"), ("p", day, None)],
        "player_name string, report_date date, injury_designation string",
    )
    got = [tuple(r) for r in injury_days(games, hurt, days=14, min_games=0).orderBy("player_name", "report_date").collect()]
    assert got == [
        ("p", day, 1, 2, 15.15, 2, 5.5), ("p", day + 60 * DAY, 1, 0, None, 0, None), ("q", day, 1, 0, None, 0, None),
    ]
    assert injury_days(games, hurt, days=14, min_games=2).count() == 1
