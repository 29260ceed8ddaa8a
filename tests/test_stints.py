"""Two-sided stints, events in them, and totals that add up."""

import random
import re

from pyspark.sql import functions as F

from tidemark.operators import marts, stints
from tidemark.operators.efficiency import stint_intervals
from tidemark.plans import inputs, mart_queries, writer_queries

COUNTS = ["points", "fga", "fta", "oreb", "tov"]
EVENT = "game int, home boolean, t int, points int, fga int, fta int, oreb int, tov int"


def brute_force(presences, events):
    out = {}
    for game in {p[0] for p in presences}:
        own = [p for p in presences if p[0] == game and p[3] is not None and p[4] is not None and p[3] < p[4] and p[1] is not None]
        points = sorted({t for p in own for t in p[3:5]})
        for no, (a, b) in enumerate(zip(points, points[1:], strict=False), 1):
            sides = [sorted({p[2] for p in own if p[1] is side and p[3] <= a < p[4]}) for side in (True, False)]
            inside = [e for e in events if e[0] == game and e[2] is not None and a <= e[2] < b]
            sums = [[sum(e[3 + i] for e in inside if e[1] is side) for i in range(5)] for side in (True, False)]
            poss = [s[1] + 0.44 * s[2] - s[3] + s[4] for s in sums]
            out[game, no] = (a, b, *sides, sums[0][0], sums[1][0], *(round(p, 9) for p in poss))
    return out


def test_events_and_totals(spark):
    rng = random.Random(6)
    presences = []
    for game in range(6):
        for _ in range(14):
            a = rng.randrange(0, 60, 5)
            presences.append((game, rng.random() < 0.5, rng.randrange(9), a, a + rng.randrange(0, 40, 5)))
    presences += [(0, True, 1, None, 5), (0, None, 1, 0, 99), (9, True, 1, 10, 20), (9, False, 2, 30, 40)]
    events = [(g, rng.random() < 0.5, rng.randrange(-5, 110), rng.randrange(4), *(rng.randrange(2) for _ in range(4))) for g in [*range(6), 9] for _ in range(40)]
    events += [(0, True, None, 3, 1, 0, 0, 0), (77, True, 5, 2, 1, 0, 0, 0)]
    p = spark.createDataFrame(presences, "game int, home boolean, member int, a int, b int")
    e = spark.createDataFrame(events, EVENT)
    found = stints.two_sided_stints(p, "game", "home", "member", "a", "b")
    assigned = stints.events_in_stints(e, found, "game", "t")
    assert assigned.count() == len(events)
    totals = stints.stint_totals(assigned, found, "game", "home", COUNTS)
    got = {(r.game, r.stint_no): (r.stint_start, r.stint_end, r.home_lineup, r.away_lineup, r.home_points, r.away_points, round(r.home_poss, 9), round(r.away_poss, 9)) for r in totals.collect()}
    assert got == brute_force(presences, events)
    assert any(not v[2] and not v[3] for v in got.values()), "a stretch with nobody on the floor"
    assert stints.unreconciled_games(totals, e, assigned, "game", "points").isEmpty()
    short = stints.unreconciled_games(totals.where("stint_no > 1"), e, assigned, "game", "points")
    assert not short.isEmpty()


def test_no_events_and_no_stints(spark):
    p = spark.createDataFrame([(1, True, 1, 0, 5)], "game int, home boolean, member int, a int, b int")
    e = spark.createDataFrame([], EVENT)
    found = stints.two_sided_stints(p, "game", "home", "member", "a", "b")
    totals = stints.stint_totals(stints.events_in_stints(e, found, "game", "t"), found, "game", "home", COUNTS).collect()
    assert [(r.home_lineup, r.away_lineup, r.home_points, r.away_poss) for r in totals] == [([1], [], 0, 0.0)]
    none = stints.two_sided_stints(p.limit(0), "game", "home", "member", "a", "b")
    late = stints.events_in_stints(spark.createDataFrame([(1, True, 5, 1, 0, 0, 0, 0)], EVENT), none, "game", "t")
    assert [r.stint_no for r in late.collect()] == [None]


def dealt_to(df, capsys):
    """The numbers of parts of the shuffles of a plan."""
    capsys.readouterr()
    df.explain()
    return [int(n) for n in re.findall(r"Exchange hashpartitioning\(.*?, (\d+)\)", capsys.readouterr().out)]


def test_games_and_entities_are_dealt_finely_and_once(spark, capsys):
    rng = random.Random(8)
    presences = [(g, True, rng.choice([1, 2, 3, None]), a := rng.randrange(9), a + rng.randrange(9)) for g in [None, *range(5)] for _ in range(12)]
    p = spark.createDataFrame(presences, "game int, home boolean, member int, a int, b int")
    found = stints.two_sided_stints(p, "game", "home", "member", "a", "b", 7)
    assert dealt_to(found, capsys) == [7]
    known = [x for x in presences if x[2] is not None] + [(*x[:2], 99, *x[3:]) for x in presences if x[2] is None]
    want = {k: (*v[:2], [m for m in v[2] if m != 99]) for k, v in brute_force(known, []).items()}
    assert {(r.game, r.stint_no): (r.stint_start, r.stint_end, r.home_lineup) for r in found.collect()} == want
    plain = stint_intervals(p, "game", "member", "a", "b", 7)
    assert dealt_to(plain, capsys) == [7]
    assert {(r.game, r.stint_no): (r.stint_start, r.stint_end, r.lineup) for r in plain.collect()} == {k: v for k, v in want.items() if v[2]}
    spells = spark.range(400).select((F.col("id") % 40).alias("p"), (F.col("id") % 7).alias("t"), (F.col("id") % 9).alias("s"))
    assert dealt_to(marts.attribute_cohort(spells, "p", "t", "s", tasks=9), capsys)[0] == 9


def test_tasks_follow_the_scanned_table(spark, tmp_path, capsys):
    """Ever more rows must not meet in one task: the parts are more with more input, not a fixed number or by shuffled bytes."""
    day = "timestamp '1999-01-01' + make_interval(0, 0, 0, cast(id % 900 as int))"
    columns = ["id div 4 as l_orderkey", "id % 50 as l_suppkey", "cast(id % 9 as double) as l_quantity", f"{day} as l_shipdate"]
    orders = ["id as o_orderkey", "id % 30 as o_custkey", "'F' as o_orderstatus", f"{day} as o_orderdate"]
    seen = []
    for files in (1, 24):
        d = f"{tmp_path}/{files}"
        spark.range(2400).selectExpr(*columns).repartition(files).write.parquet(f"{d}/lineitem.parquet")
        spark.range(600).selectExpr(*orders).write.parquet(f"{d}/orders.parquet")
        spark.range(50).selectExpr("id as s_suppkey", "concat('S', id) as s_name").write.parquet(f"{d}/supplier.parquet")
        tasks = inputs.finely(spark.read.parquet(f"{d}/lineitem.parquet"))
        assert dealt_to(mart_queries.stint_intervals(spark, d), capsys) == [tasks]
        assert dealt_to(mart_queries.cohort_attribution(spark, d), capsys).count(tasks) >= 2
        joined = writer_queries.bucketed_join(spark, d)
        assert dealt_to(joined, capsys) == [] and joined.agg(F.sum("lines")).first()[0] == 2400
        capsys.readouterr()
        joined.explain()
        seen.append((tasks, max(8, tasks // 4)))
        assert f"out of {seen[-1][1]}" in capsys.readouterr().out
    assert seen[1][0] > seen[0][0] and seen[1][1] > seen[0][1]
