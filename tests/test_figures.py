"""Known totals of the derived tables at sf0.01."""

from pyspark.sql import functions as F

import __spark_entry__ as entry

SF = "/root/testdata/sf0.01"


def test_figures(spark):
    q = entry.queries()
    clean = q["clean_events"](spark, SF)
    totals = clean.agg(
        F.count(F.lit(1)), F.count_if("is_late_arrival"), F.sum(F.col("line_amount").cast("decimal(18,2)"))
    ).first()
    assert [str(v) for v in totals] == ["44266", "19100", "19486528217.71"]
    assert q["dedupe_events"](spark, SF).count() == 45832
    assert q["quarantined_events"](spark, SF).count() == 1566

    history = q["dim_customer_scd2"](spark, SF)
    assert (history.count(), history.where("is_current").count()) == (11172, 1499)

    fact = q["fct_sales"](spark, SF)
    totals = fact.agg(
        F.count(F.lit(1)), F.count("customer_sk"), F.sum(F.col("line_amount").cast("decimal(18,2)"))
    ).first()
    assert [str(v) for v in totals] == ["26455", "22088", "35498869087.38"]

    ltv = q["mart_customer_ltv"](spark, SF)
    assert (ltv.count(), ltv.where("total_orders > 0").count()) == (1499, 1275)
    assert q["mart_daily_store_sales"](spark, SF).count() == 25007
