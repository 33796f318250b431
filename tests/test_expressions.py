"""Column expressions: sizes, money sums, banding."""

from pyspark.sql import functions as F

from lakeforge.functions import expressions as X


def test_pretty_size_units(spark):
    values = [0, 10239, 10240, 10 * 1024 * 1024 - 1, 10 * 1024 * 1024 * 1024 * 5, 30 * 1024**4]
    df = spark.createDataFrame([(v,) for v in values], "b bigint")
    got = [r[0] for r in df.select(X.pretty_size("b")).collect()]
    assert got == ["0 bytes", "10239 bytes", "10 kB", "10240 kB", "50 GB", "30 TB"]


def test_money_sum_is_exact_and_order_free(spark):
    # 0.1 + 0.2 != 0.3 in binary floating point; the decimal sum is exact
    df = spark.createDataFrame([(g, v) for g in ("a", "b") for v in (0.1, 0.2)], "g string, v double")
    got = {r["g"]: r["s"] for r in df.groupBy("g").agg(X.money_sum("v").alias("s")).collect()}
    assert got == {"a": 0.3, "b": 0.3}


def test_money_avg_all_null_group_is_null(spark):
    df = spark.createDataFrame([("a", None), ("b", 2.0)], "g string, v double")
    got = {r["g"]: r["m"] for r in df.groupBy("g").agg(X.money_avg("v").alias("m")).collect()}
    assert got == {"a": None, "b": 2.0}


def test_banded_and_severity(spark):
    df = spark.createDataFrame([(None, "x"), (-5, "ERROR")], "age int, level string")
    out = df.select(X.age_group("age").alias("g"), X.severity_level("level").alias("s")).collect()
    assert [(r["g"], r["s"]) for r in out] == [("senior", 1), ("young", 3)]


def test_passes_treats_null_as_false(spark):
    df = spark.createDataFrame([(None,), (1,)], "x int")
    got = [r[0] for r in df.select(X.passes(F.col("x") > 0)).collect()]
    assert got == [False, True]


def test_sized_conf_scales_and_clamps():
    from lakeforge.session import sized_conf

    assert sized_conf(10**6)["spark.sql.shuffle.partitions"] == "200"
    big = int(sized_conf(100 * 10**12)["spark.sql.shuffle.partitions"])
    assert 20_000 < big <= 50_000
    assert sized_conf(10**18, most=50_000)["spark.sql.shuffle.partitions"] == "50000"  # the upper end is a parameter


def test_money_keeps_digits_and_odd_values(spark):
    data = [("sub", 0.004), ("sub", 0.004), ("sub", 1.005), ("nan", float("nan")), ("nan", 2.0), ("big", 1e17), ("big", 1.0), ("none", None)]
    df = spark.createDataFrame(data, "g string, v double").groupBy("g").agg(X.money_sum("v").alias("s"), X.money_avg("v").alias("m"))
    got = {r["g"]: (r["s"], r["m"]) for r in df.collect()}
    assert got["sub"][0] == 1.013 and got["nan"][0] != got["nan"][0] and got["nan"][1] != got["nan"][1]
    assert got["big"] == (1e17 + 1.0, (1e17 + 1.0) / 2) and got["none"] == (None, None)


def test_money_over_many_sizes_equals_decimal_sums(spark):
    from decimal import Decimal

    amounts = ["0.00000001", "-0.00000001", "1234567.89", "9999999.99999999", "12345678.123456", "-87654321.654321", "99999999999.1234", "-3.01", "0.1", "0.2", "5e10"]
    data = [(str(k % 3), float(a)) for k, a in enumerate(amounts * 7)]
    want = {}
    for g, v in data:
        want[g] = want.get(g, Decimal(0)) + Decimal(repr(v))
    df = spark.createDataFrame(data, "g string, v double")
    parts = df.groupBy("g", (F.rand(1) * 4).cast("int")).agg(*X.money_state("v"))
    for made in (df.groupBy("g").agg(X.money_sum("v").alias("s")), parts.groupBy("g").agg(*X.merged_money()).select("g", X.money_total().alias("s"))):
        assert {r["g"]: r["s"] for r in made.collect()} == {g: float(v) for g, v in want.items()}
    twice = parts.groupBy("g").agg(*X.merged_money()).select("g", X.money_total(F.lit(3)).alias("s")).collect()
    assert all(abs(r["s"] - float(3 * want[r["g"]])) <= 1e-5 for r in twice)


def test_money_whose_integer_sums_overflow_is_summed_plainly(spark):
    state = spark.createDataFrame([(1 << 62, 5, 0, 10, 7.5, 10), (1 << 62, 5, 0, 10, 2.5, 10)], "units long, parts long, rest long, fitting long, plain double, amounts long")
    assert state.agg(*X.merged_money()).select(X.money_total()).first()[0] == 10.0
