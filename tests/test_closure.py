import datetime as dt

from ratesmith.operators.closure import rate_closure

D1 = dt.date(2024, 1, 1)
D2 = dt.date(2024, 1, 2)
SCHEMA = "date date, asset string, quote string, rate double"


def test_members_and_priority(spark):
    src = spark.createDataFrame([(D1, "USD", "UAH", 40.0), (D1, "EUR", "USD", 1.1)], SCHEMA)
    got = {(r.asset, r.quote): r.rate for r in rate_closure(src).collect()}
    assert got == {
        ("USD", "UAH"): 40.0, ("UAH", "USD"): 1 / 40.0,
        ("EUR", "USD"): 1.1, ("USD", "EUR"): 1 / 1.1,
        ("USD", "USD"): 1.0, ("UAH", "UAH"): 1.0, ("EUR", "EUR"): 1.0,
    }


def test_source_beats_derived_even_when_null(spark):
    src = spark.createDataFrame(
        [(D1, "USD", "UAH", 40.0), (D1, "UAH", "USD", None)], SCHEMA)
    got = {(r.asset, r.quote): r.rate for r in rate_closure(src).collect()}
    # the NULL source rate (priority 1) beats the inverse 1/40 (priority 2)
    assert got[("UAH", "USD")] is None
    # and its own inverse is NULL, but the direct source wins anyway
    assert got[("USD", "UAH")] == 40.0


def test_zero_rate_inverse_is_null(spark):
    src = spark.createDataFrame([(D1, "X", "Y", 0.0)], SCHEMA)
    got = {(r.asset, r.quote): r.rate for r in rate_closure(src).collect()}
    assert got[("Y", "X")] is None and got[("X", "Y")] == 0.0


def test_one_row_per_key_and_tie_break(spark):
    src = spark.createDataFrame(
        [(D1, "A", "B", 3.0), (D1, "A", "B", 2.0), (D2, "A", "B", 5.0), (D1, "A", "A", 7.0)], SCHEMA)
    out = rate_closure(src)
    keys = out.select("date", "asset", "quote")
    assert keys.count() == keys.distinct().count()
    got = {(r.date, r.asset, r.quote): r.rate for r in out.collect()}
    assert got[(D1, "A", "B")] == 2.0          # equal priority: lowest rate
    assert got[(D1, "B", "A")] == 1 / 3.0      # equal priority: the lowest inverse
    assert got[(D1, "A", "A")] == 7.0          # a source row beats identity
    assert got[(D2, "A", "B")] == 5.0


def test_columns(spark):
    src = spark.createDataFrame([(D1, "A", "B", 1.0)], SCHEMA)
    assert rate_closure(src).columns == ["date", "asset", "quote", "rate"]


def test_plan_single_scan_single_shuffle(spark, scratch):
    src = spark.createDataFrame([(D1, "A", "B", 1.0), (D2, "B", "C", 2.0)], SCHEMA)
    src.write.parquet(f"{scratch}/cl")
    plan = rate_closure(spark.read.parquet(f"{scratch}/cl"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 or plan.count("Scan parquet") == 1
    assert plan.count("Exchange hashpartitioning") == 1


def test_matches_brute_force_on_random_rows(spark):
    import random

    rnd = random.Random(11)
    cur = ["A", "B", "C", "D", None]
    data = []
    for _ in range(400):
        a, q = rnd.choice(cur), rnd.choice(cur)
        r = rnd.choice([None, 0.0, float(rnd.randint(1, 9)), float(rnd.randint(1, 9))])
        data.append((rnd.choice([D1, D2, None]), a, q, r))
    got = {(r.date, r.asset, r.quote): r.rate for r in rate_closure(spark.createDataFrame(data, SCHEMA)).collect()}
    members = {}
    for d, a, q, r in data:
        inv = None if r in (None, 0.0) else 1.0 / r
        for key, prio, val in (((d, a, q), 1, r), ((d, a, a), 2, 1.0), ((d, q, q), 3, 1.0), ((d, q, a), 2, inv)):
            members.setdefault(key, []).append((prio, val))
    want = {k: min(v, key=lambda m: (m[0], m[1] is not None, m[1] or 0.0))[1] for k, v in members.items()}
    assert got == want
