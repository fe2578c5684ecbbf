"""The ticket view: no sale after its event, no ticket lost to a filter on days out."""

from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from turnstone.sources.tables import Tables
from turnstone.sources.views import tickets

FOLDER = "/root/testdata/sf0.001"


def test_sales_precede_events(spark):
    every = tickets(Tables(spark, FOLDER))
    assert every.where("days_out < 0 or transaction_date > event_date or days_out <> datediff(event_date, transaction_date)").isEmpty()
    assert every.where("days_out >= 0").count() == spark.read.parquet(f"{FOLDER}/lineitem.parquet").count()


def test_totals_are_those_of_the_whole_table(spark):
    queries = entry_module.queries()
    paid = tickets(Tables(spark, FOLDER)).agg(F.sum("paid_seats")).first()[0]

    def total(name, column):
        return queries[name](spark, FOLDER).agg(F.sum(column)).first()[0]

    assert total("w3_running_sum", "paid") == paid
    assert total("u1_union_all", "paid") == paid
    assert total("d30_attendance_history", "paid_seats") == paid
    curves = queries["w14_final_in_group"](spark, FOLDER).select("season", "ticket_type", "final").distinct()
    assert curves.agg(F.sum("final")).first()[0] == paid
    shares = queries["w15_percent_of_final"](spark, FOLDER)
    assert shares.agg(F.sum(F.when(F.col("share_in") == F.lit(1.0), 1).otherwise(0))).first()[0] >= curves.count()
