from pyspark.sql import functions as F

from callweave.functions import names as N


def test_name_functions(spark):
    rows = [("shop.promo.Brand1.m1",), (".C.m",), ("a.b.",), ("abc",), ("a..b",), ("super.m",)]
    df = spark.createDataFrame(rows, "x string")
    out = df.select("x", N.class_of_method("x").alias("c"), N.method_of("x").alias("m"),
                    N.short_name("x").alias("s"), N.group_package("x").alias("g"),
                    N.simplify_name("x").alias("v")).collect()
    got = {r.x: (r.c, r.m, r.s, r.g, r.v) for r in out}
    assert got["shop.promo.Brand1.m1"] == ("shop.promo.Brand1", "m1", "m1", "shop.promo", "Brand1.m1")
    assert got[".C.m"] == (".C", "m", "m", "", "C.m")
    assert got["a.b."] == ("a.b", "a.b.", "", "a", "a.b")
    assert got["abc"] == (None, "abc", "abc", "default", "abc")
    assert got["a..b"][0] == "a."
    assert got["super.m"] == ("super", "m", "m", "super", "super.m")


def test_predicates(spark):
    df = spark.createDataFrame([("java.util.List",), ("shop.A",), (None,)], "x string")
    r = df.select(N.is_system_class("x").alias("s")).collect()
    assert [x.s for x in r] == [True, False, False]
    assert spark.range(1).select(N.full_class_name(F.lit(""), F.lit("C"))).first()[0] == "C"
