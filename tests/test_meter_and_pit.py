import datetime as dt
from decimal import Decimal


from ledgerflow.operators.pit import pit_match_counts, point_in_time_join
from ledgerflow.plans.meter import day_profiles, fold_half_hours

DAY = dt.date(2024, 1, 1)


def test_half_hour_fold(spark):
    reads = spark.createDataFrame(
        [(1, "AI", "r1", DAY, 3, Decimal("1.00"), "A"), (1, "AI", "r2", DAY, 3, Decimal("2.00"), "E")],
        "meter_id long, qty string, register string, read_day date, hh int, reading decimal(18,2), flag string")
    p = day_profiles(fold_half_hours(reads)).first()
    assert len(p.hh_values) == 48 and len(p.hh_flags) == 48
    assert p.hh_values[3] == Decimal("3.00") and p.hh_flags[3] == "E"
    assert all(v == 0 for i, v in enumerate(p.hh_values) if i != 3)
    assert all(f == "A" for i, f in enumerate(p.hh_flags) if i != 3)


def test_fold_first_non_default_flag_by_register(spark):
    reads = spark.createDataFrame(
        [(1, "AI", "b", DAY, 0, Decimal("1"), "X"), (1, "AI", "a", DAY, 0, Decimal("1"), "E"),
         (1, "AI", "c", DAY, 0, Decimal("1"), "A")],
        "meter_id long, qty string, register string, read_day date, hh int, reading decimal(18,2), flag string")
    assert fold_half_hours(reads).first().flag == "E"


def test_point_in_time_half_open(spark):
    fact = spark.createDataFrame([(1, DAY), (1, DAY + dt.timedelta(days=90)), (2, DAY)], "pid long, d date")
    dim = spark.createDataFrame([(1, DAY, DAY + dt.timedelta(days=90), "v1"),
                                 (1, DAY + dt.timedelta(days=90), None, "v2")],
                                "pid long, f date, t date, ver string")
    got = sorted((r.pid, r.d, r.ver) for r in point_in_time_join(fact, dim, ["pid"], "d", "f", "t").collect())
    assert got == [(1, DAY, "v1"), (1, DAY + dt.timedelta(days=90), "v2"), (2, DAY, None)]
    counts = {(r.pid, r.d): r.match_cnt for r in
              pit_match_counts(fact, dim, ["pid", "d"], ["pid"], "d", "f", "t").collect()}
    assert counts[(2, DAY)] == 0 and counts[(1, DAY)] == 1


def test_bucketed_point_in_time_equals_plain(spark):
    import random
    rnd = random.Random(7)
    versions, facts = [], []
    for k in range(5):
        start = DAY
        for v in range(rnd.randint(1, 12)):  # many versions per key
            end = start + dt.timedelta(days=rnd.randint(5, 70))
            versions.append((k, start, end if v < 11 else None, f"{k}-{v}"))
            start = end + dt.timedelta(days=rnd.randint(0, 3))  # gaps between some versions
        versions[-1] = versions[-1][:2] + (None, versions[-1][3])
        facts += [(k, DAY + dt.timedelta(days=rnd.randint(-10, 900))) for _ in range(40)]
    fact = spark.createDataFrame(facts, "pid long, d date")
    dim = spark.createDataFrame(versions, "pid long, f date, t date, ver string")
    for b in ("month", "year"):
        plain = sorted(point_in_time_join(fact, dim, ["pid"], "d", "f", "t").collect())
        bucketed = sorted(point_in_time_join(fact, dim, ["pid"], "d", "f", "t", bucket=b).collect())
        assert plain == bucketed
