from tillroll.operators import quality as q
from tillroll.plans.report import METRICS, as_text


def counts(df):
    return {(r.check, r.column): (r.n_violations, r.status) for r in df.collect()}


def test_all_kinds(spark):
    t = spark.createDataFrame(
        [(1, "gold", 5.0), (1, "tin", -1.0), (2, None, None), (None, "gold", 11.0), (None, "gold", 0.0)],
        "id int, tier string, price double",
    )
    parents = spark.createDataFrame([(1,), (3,)], "key int")
    checks = [
        q.unique("t", "id"),
        q.not_null("t", "id"),
        q.not_null("t", "tier"),
        q.accepted_values("t", "tier", ["gold"]),
        q.accepted_range("t", "price", 0, 10),
        q.relationships("t", "id", "p", "key"),
    ]
    got = counts(q.run_checks(checks, {"t": t, "p": parents}))
    assert got == {
        ("unique", "id"): (1, "fail"),
        ("not_null", "id"): (2, "fail"),
        ("not_null", "tier"): (1, "fail"),
        ("accepted_values", "tier"): (1, "fail"),
        ("accepted_range", "price"): (2, "fail"),
        ("relationships", "id"): (1, "fail"),
    }


def test_range_bounds_are_inclusive_and_optional(spark):
    t = spark.createDataFrame([(0,), (10,), (11,)], "x int")
    n = {
        bounds: q.violations(q.accepted_range("t", "x", *bounds), {"t": t}).count()
        for bounds in [(0, 10), (1, None), (None, 9), (None, None)]
    }
    assert n == {(0, 10): 1, (1, None): 1, (None, 9): 2, (None, None): 0}


def test_large_parent_side(spark, monkeypatch):
    monkeypatch.setattr(q, "broadcast_if_small", lambda df: df)
    child = spark.createDataFrame([(1,), (2,), (None,)], "c int")
    assert [r.c for r in q.orphans(child, "c", spark.createDataFrame([(1,)], "k int"), "k").collect()] == [2]


def test_one_current_row(spark):
    t = spark.createDataFrame(
        [("a", True), ("a", False), ("b", True), ("b", True), ("c", False)], "k string, is_current boolean"
    )
    rows = q.violations(q.one_current_row("t", "k"), {"t": t}).orderBy("k").collect()
    assert [tuple(r) for r in rows] == [("b", 2), ("c", 0)]


def test_line_amount(spark):
    t = spark.createDataFrame(
        [(2, 5.0, 1.0, 9.0), (2, 5.0, 1.0, 9.005), (2, 5.0, 1.0, 9.02)],
        "quantity int, unit_price double, discount_amount double, line_amount double",
    )
    assert q.violations(q.line_amount_matches("t"), {"t": t}).count() == 1


def test_row_checks_of_a_table_share_one_pass(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).selectExpr("id as a", "id as b", "id as c").write.parquet(path)
    t = spark.read.parquet(path)
    suite = q.run_checks([q.not_null("t", c) for c in "abc"] + [q.accepted_range("t", "a", 0)], {"t": t})
    plan = suite._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1


def test_unique_columns_of_a_table_share_one_scan_and_one_shuffle(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(1, "a", 0.0, "x"), (1, "b", -0.0, None), (None, "b", 1.5, None), (2, "b", float("nan"), "y"), (3, "c", float("nan"), "z")]
    spark.createDataFrame(rows, "a long, b string, c double, d string").write.parquet(path)
    t = spark.read.parquet(path)
    suite = q.run_checks([q.unique("t", c) for c in "abcd"], {"t": t})
    plan = suite._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and plan.count("Exchange hashpartitioning(place") <= 2
    assert {r.column: r.n_violations for r in suite.collect()} == {"a": 1, "b": 1, "c": 2, "d": 0}


def test_foreign_keys_of_a_table_share_one_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(1, "a"), (1, "b"), (None, "zz"), (7, "zz"), (7, None), (8, "a")]
    spark.createDataFrame(rows, "n long, s string").write.parquet(path)
    t = spark.read.parquet(path)
    tables = {
        "t": t,
        "numbers": spark.createDataFrame([(1,), (2,), (2,), (None,)], "k int"),
        "letters": spark.createDataFrame([("a",), ("b",)], "k string"),
    }
    checks = [q.relationships("t", "n", "numbers", "k"), q.relationships("t", "s", "letters", "k")]
    suite = q.run_checks(checks, tables)
    assert suite._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 1
    assert {r.column: r.n_violations for r in suite.collect()} == {"n": 3, "s": 2}
    assert all(q.violations(c, tables).count() == n for c, n in zip(checks, (3, 2), strict=True))


def test_suite_size():
    checks = q.retail_checks()
    assert len(checks) == 51 == len({(c.kind, c.table, c.column) for c in checks})


def test_counts_survive_a_broken_table(spark, tmp_path):
    rows = q.table_counts(
        spark,
        {"ok": lambda: spark.range(3), "gone": lambda: spark.read.parquet(str(tmp_path / "nothing"))},
    ).collect()
    assert (rows[0].n_rows, rows[0].error) == (3, None)
    assert rows[1].n_rows is None and rows[1].error.startswith("error: ")


def test_report(spark):
    rows = [
        ("table", "fct_sales", 1007, None),
        ("table", "dim_date", None, "error: gone"),
        ("rejected", "sales events", 4, None),
        ("check", "pass", 2, None),
        ("check", "fail", 1, None),
    ]
    lines = [line.split() for line in as_text(spark.createDataFrame(rows, METRICS)).splitlines()]
    for figure in (["fct_sales", "1,007"], ["dim_date", "error:", "gone"], ["pass", "2"], ["fail", "1"]):
        assert figure in lines
    assert ["sales", "events", "4"] in lines
    assert "none were run" in as_text(spark.createDataFrame(rows[:3], METRICS))
