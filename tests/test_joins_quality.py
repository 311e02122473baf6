from pyspark.sql import functions as F

from quarry.operators import joins, quality


def _fact_with_hot_key(spark):
    # key 1 holds a third of the fact rows
    rows = [(i, 1 if i % 3 == 0 else i % 7 + 2) for i in range(300)]
    return spark.createDataFrame(rows, "id long, k long")


def test_count_through_dimension_equals_join_count(spark):
    fact = _fact_with_hot_key(spark)
    dim = spark.createDataFrame([(k, "g" + str(k % 2)) for k in range(1, 9)], "k long, g string")
    ours = {r.g: r.n for r in joins.count_through_dimension(fact, "k", "id", dim, "k", ["g"], "n").collect()}
    naive = {r.g: r.n for r in fact.join(dim, "k").groupBy("g").agg(F.count("id").alias("n")).collect()}
    assert ours == naive


def test_count_many_to_many_equals_join_count(spark):
    left = spark.createDataFrame([(i, i % 4, "m" + str(i % 3)) for i in range(40)], "id long, c long, m string")
    right = _fact_with_hot_key(spark).select("id", F.col("k").alias("c"))
    ours = {r.m: r.n for r in joins.count_many_to_many(left, "c", "id", ["m"], right, "c", "n").collect()}
    naive = {
        r.m: r.n
        for r in left.alias("l").join(right.alias("r"), "c").groupBy("m").agg(F.count(F.col("l.id")).alias("n")).collect()
    }
    assert ours == naive


def test_count_many_to_many_counts_rows_with_null_ids(spark):
    left = spark.createDataFrame([(10, 1, "x"), (None, 1, "x"), (11, 1, "y")], "id long, c long, m string")
    right = spark.createDataFrame([(5, 1), (None, 1), (6, None)], "id long, c long")
    left.createOrReplaceTempView("m2m_left")
    right.createOrReplaceTempView("m2m_right")
    plain = spark.sql("SELECT m, count(l.id) AS n FROM m2m_left l JOIN m2m_right r ON l.c = r.c GROUP BY m").collect()
    ours = joins.count_many_to_many(left, "c", "id", ["m"], right, "c", "n").collect()
    assert {r.m: r.n for r in ours} == {r.m: r.n for r in plain} == {"x": 2, "y": 2}


def test_is_bounded(spark):
    small = spark.range(10)
    assert joins.is_bounded(small, 10) and not joins.is_bounded(small, 9)


def test_duplicate_keys(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (2, 1)], "o long, l int")
    assert [(r.o, r.l, r.n_rows) for r in quality.duplicate_keys(df, ["o", "l"]).collect()] == [(1, 1, 2)]


def test_orphans_with_planted_orphan(spark):
    parent = spark.createDataFrame([(1,), (2,), (2,)], "pk long")
    child = spark.createDataFrame([(1,), (2,), (2,), (9,), (None,)], "fk long")
    row = quality.orphan_count("c->p", child, "fk", parent, "pk").first()
    assert (row.n_checked, row.n_orphans) == (4, 1)
    assert [r.fk for r in quality.orphans(child, "fk", parent, "pk").collect()] == [9]


def test_self_reference_null_allowed(spark):
    members = spark.createDataFrame([(0, None), (1, None), (2, 1), (3, 7)], "memid long, rec long")
    row = quality.orphan_count("m->m", members, "rec", members, "memid").first()
    assert (row.n_checked, row.n_orphans) == (2, 1)


def test_null_counts(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, b string")
    got = {r.column_name: r.n_null for r in quality.null_counts(df, "t").collect()}
    assert got == {"a": 1, "b": 2}


def test_aqe_splits_a_hot_join_key(spark):
    """A key holding a third of the fact rows: AQE's skew handling splits its
    partition in the sort-merge join (thresholds lowered to the test's size)."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        fact = spark.range(30000).select(
            F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
        )
        dim = spark.range(30000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
        joined = fact.join(dim, "k")
        assert joined.count() == 30000
        joined.collect()
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_spread_goes_by_its_argument_alone(spark):
    from quarry.operators.partitioning import spread, spread_setting

    narrow = spark.range(100).coalesce(1)
    assert spread_setting(spark) is None and spread(narrow, ["id"], None) is narrow
    dealt = spread(narrow, ["id"], 4)
    assert dealt.rdd.getNumPartitions() == 4 and dealt.count() == 100


def test_salted_join_equals_plain_join_and_spreads_the_hot_key(spark):
    fact = _fact_with_hot_key(spark)  # key 1 holds a third of the rows
    dim = spark.createDataFrame([(k, "n" + str(k)) for k in range(0, 12)], "dk long, name string")
    n = fact.where("k = 1").count()
    hot = joins.hot_keys(fact, "k", 50)
    assert [tuple(r) for r in hot.collect()] == [(1, -(-n // 50))]
    salted = joins.salted_join(fact, dim, "k", "dk", hot)
    plain = fact.join(dim, F.col("k") == F.col("dk"))
    assert sorted(map(tuple, salted.collect())) == sorted(map(tuple, plain.collect()))
    assert salted.columns == plain.columns
    # the hot key's rows land on several salts
    f = fact.withColumn("s", F.pmod(F.xxhash64(*fact.columns), F.lit(8)))
    assert f.filter("k = 1").select("s").distinct().count() > 4


def test_salted_left_joins_keep_rows_without_a_match_and_names_do_not_clash(spark):
    fact = spark.createDataFrame([(k, i, "h") for i, k in enumerate([1] * 40 + [2, 3, None])], "k long, salt long, hot_key string")
    dim = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "dk long, salts string")
    hot = joins.hot_keys(fact, "k", 7)
    for how in ("left", "left_semi", "left_anti"):
        got, want = joins.salted_join(fact, dim, "k", "dk", hot, how), fact.join(dim, F.col("k") == F.col("dk"), how)
        assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_salted_star_join_matches_default(wh):
    from quarry.plans import analog

    plain = analog.model_filter(analog.client_star(wh))
    salted = analog.model_filter(analog.client_star(wh, rows_per_salt=3))
    key = ["order_id", "line_no", "S_years", "R_years", "Educ"]
    assert sorted(map(tuple, salted.select(*key).collect())) == sorted(map(tuple, plain.select(*key).collect()))
