import random

from pyspark.sql import functions as F

from jobloom.operators.ordering import carry_down, number_rows, record_id


def _rows(spark, n=3000, seed=5):
    """Orders from dense to very sparse, a third of them under one key."""
    rng = random.Random(seed)
    orders = set(range(n // 3)) | {rng.getrandbits(62) for _ in range(n // 3)}
    orders |= {(p << 33) + i for p in range(10) for i in range(n // 30)}
    rows = [
        (o, "hot" if i % 3 == 0 else f"k{i % 50}", rng.choice([None, None, "a", "b", ""]))
        for i, o in enumerate(orders)
    ]
    rng.shuffle(rows)
    return rows, spark.createDataFrame(rows, "ord bigint, k string, v string").repartition(7)


def test_numbers_match_brute_force(spark):
    rows, df = _rows(spark)
    expected = {o: i for i, (o, _, _) in enumerate(sorted(rows), 1)}
    assert {r.ord: r.seq for r in number_rows(df).collect()} == expected
    within = {}
    for o, k, _ in sorted(rows):
        within.setdefault(k, []).append(o)
    expected = {o: i for orders in within.values() for i, o in enumerate(orders, 1)}
    assert {r.ord: r.seq for r in number_rows(df, within=["k"]).collect()} == expected


def test_carry_down_matches_brute_force(spark):
    rows, df = _rows(spark, seed=6)
    expected, last = {}, {}
    for o, k, v in sorted(rows):
        if v is not None:
            last[k] = v
        expected[o] = last.get(k)
    carried = carry_down(df.select("ord", "k", "v"), within=["k"], values={"c": F.col("v")})
    assert {r.ord: r.c for r in carried.collect()} == expected


def test_negative_orders_and_empty_input(spark):
    df = spark.createDataFrame([(-5,), (3,), (-(1 << 62),)], "ord bigint")
    assert {r.ord: r.seq for r in number_rows(df).collect()} == {-(1 << 62): 1, -5: 2, 3: 3}
    assert number_rows(df.limit(0)).count() == 0


def test_no_task_numbers_more_than_the_partitions(spark):
    """Sparse orders, as of pages: every row in a range of its own, and one hot key."""
    df = spark.range(4000).select((F.col("id") * (1 << 28)).alias("ord"), F.lit("hot").alias("k"))
    numbered = number_rows(df)
    plan = numbered._jdf.queryExecution().optimizedPlan().toString()
    assert "partition" not in plan.lower() or "_part" in plan
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert len(windows) == 1 and "_rows" in windows[0]
    assert [r.seq for r in numbered.orderBy("ord").select("seq").collect()] == list(range(1, 4001))


def test_null_keys_are_numbered(spark):
    df = spark.createDataFrame([(1, None), (2, "a"), (3, None)], "ord bigint, k string")
    assert {r.ord: r.seq for r in number_rows(df, within=["k"]).collect()} == {1: 1, 2: 1, 3: 2}


def test_ids_are_padded_and_never_cut(spark):
    df = spark.createDataFrame([(7,), (12345,)], "n bigint")
    ids = [r.i for r in df.select(record_id(F.col("n")).alias("i")).collect()]
    assert ids == ["IND0007", "IND12345"]
