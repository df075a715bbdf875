"""Map the driver's TPC-H-like tables onto the eight domain tables, so the
real domain plans run over them (every column is derived by Spark from the
given rows; work grows with the tables).

  application          <- customer (+ nation)
  bureau               <- orders          (loan = order, status F/O/P)
  bureau_balance       <- lineitem        (monthly rows of an order)
  previous_application <- orders          (status Approved/Refused/Canceled)
  pos_cash             <- lineitem + orders
  installments         <- lineitem + orders
  credit_card          <- events          (borrower = user_id)
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlens.session import write_table

REF_DATE = "2002-01-01"


def _days(ts_col: str):
    return F.datediff(F.col(ts_col).cast("date"), F.to_date(F.lit(REF_DATE)))


def load_driver(spark: SparkSession, sf_dir: str, names=None) -> dict[str, DataFrame]:
    names = names or ["customer", "nation", "orders", "lineitem", "events",
                      "documents", "labels", "region", "supplier", "part"]
    return {n: spark.read.parquet(os.path.join(sf_dir, f"{n}.parquet")) for n in names}


def application_from_customer(customer: DataFrame, nation: DataFrame) -> DataFrame:
    c = customer.join(nation, customer.c_nationkey == nation.n_nationkey, "left")
    k, bal = F.col("c_custkey"), F.abs(F.col("c_acctbal"))
    credit = bal * 40 + 50000
    return c.select(
        k.alias("SK_ID_CURR"),
        F.when(k % 4 == 3, None).otherwise((F.col("c_acctbal") < 2500).cast("int")).alias("TARGET"),
        F.when(k % 3 == 0, "Revolving loans").otherwise("Cash loans").alias("NAME_CONTRACT_TYPE"),
        F.when(F.col("c_nationkey") % 2 == 0, "F").otherwise("M").alias("CODE_GENDER"),
        F.when(k % 2 == 0, "Y").otherwise("N").alias("FLAG_OWN_CAR"),
        F.when(k % 5 < 3, "Y").otherwise("N").alias("FLAG_OWN_REALTY"),
        F.when(k % 7 == 0, None).otherwise(F.concat(F.lit("suite_"), (k % 3).cast("string"))).alias("NAME_TYPE_SUITE"),
        F.when(k % 50 == 1, "Maternity leave").otherwise(F.concat(F.lit("income_"), (k % 4).cast("string"))).alias("NAME_INCOME_TYPE"),
        F.col("c_mktsegment").alias("NAME_EDUCATION_TYPE"),
        F.when(k % 40 == 2, "Unknown").otherwise(F.concat(F.lit("family_"), (k % 3).cast("string"))).alias("NAME_FAMILY_STATUS"),
        F.concat(F.lit("housing_"), (k % 2).cast("string")).alias("NAME_HOUSING_TYPE"),
        F.when(k % 9 == 0, None).otherwise(F.col("n_name")).alias("OCCUPATION_TYPE"),
        F.concat(F.lit("DAY_"), (k % 7).cast("string")).alias("WEEKDAY_APPR_PROCESS_START"),
        F.concat(F.lit("ORG_"), F.col("n_regionkey").cast("string")).alias("ORGANIZATION_TYPE"),
        F.when(k % 6 == 0, None).otherwise("reg oper account").alias("FONDKAPREMONT_MODE"),
        F.concat(F.lit("wall_"), (k % 3).cast("string")).alias("WALLSMATERIAL_MODE"),
        (k % 4).cast("int").alias("CNT_CHILDREN"),
        (bal * 10 + 25000).alias("AMT_INCOME_TOTAL"),
        credit.alias("AMT_CREDIT"),
        F.when(k % 13 == 0, None).otherwise(credit / 20).alias("AMT_ANNUITY"),
        F.when(k % 11 == 0, None).otherwise(credit * (0.8 + (k % 5) * 0.05)).alias("AMT_GOODS_PRICE"),
        ((k % 100) / 1000.0).alias("REGION_POPULATION_RELATIVE"),
        (-(F.lit(7000) + (k * 37) % 18000)).cast("int").alias("DAYS_BIRTH"),
        F.when(k % 10 == 0, 365243).otherwise(-((k * 13) % 9000)).cast("int").alias("DAYS_EMPLOYED"),
        (-((k * 7) % 12000)).cast("double").alias("DAYS_REGISTRATION"),
        (-((k * 17) % 6000)).cast("int").alias("DAYS_ID_PUBLISH"),
        F.when(k % 8 == 0, None).otherwise((k % 20).cast("double")).alias("OWN_CAR_AGE"),
        ((k % 4) + 1 + F.col("c_nationkey") % 2).cast("double").alias("CNT_FAM_MEMBERS"),
        (F.col("n_regionkey") % 3 + 1).cast("int").alias("REGION_RATING_CLIENT"),
        F.when(k % 30 == 5, -1).otherwise(F.col("n_regionkey") % 3 + 1).cast("int").alias("REGION_RATING_CLIENT_W_CITY"),
        (F.col("c_nationkey") % 3 == 0).cast("int").alias("REG_CITY_NOT_WORK_CITY"),
        F.when(k % 5 == 0, None).otherwise(((k * 31) % 1000) / 1000.0).alias("EXT_SOURCE_1"),
        F.when(k % 17 == 0, None).otherwise(((k * 53) % 1000) / 1000.0).alias("EXT_SOURCE_2"),
        F.when(k % 7 == 1, None).otherwise(((k * 71) % 1000) / 1000.0).alias("EXT_SOURCE_3"),
        ((k % 97) / 100.0).alias("APARTMENTS_AVG"),
        ((k % 89) / 100.0).alias("BASEMENTAREA_AVG"),
        ((k % 83) / 100.0).alias("YEARS_BUILD_AVG"),
        ((k % 5) / 10.0).alias("ELEVATORS_AVG"),
        ((k % 7) / 10.0).alias("FLOORSMAX_AVG"),
        ((k % 9) / 10.0).alias("LANDAREA_AVG"),
        ((k % 11) / 10.0).alias("LIVINGAPARTMENTS_AVG"),
        ((k % 13) / 10.0).alias("LIVINGAREA_AVG"),
        ((k % 3) / 10.0).alias("NONLIVINGAREA_AVG"),
        (k % 6).cast("double").alias("OBS_30_CNT_SOCIAL_CIRCLE"),
        (k % 2).cast("double").alias("DEF_30_CNT_SOCIAL_CIRCLE"),
        (k % 5).cast("double").alias("OBS_60_CNT_SOCIAL_CIRCLE"),
        (k % 3 == 0).cast("double").alias("DEF_60_CNT_SOCIAL_CIRCLE"),
        F.when(k % 15 == 0, 0.0).otherwise(-((k * 3) % 3000).cast("double")).alias("DAYS_LAST_PHONE_CHANGE"),
        (k % 2).cast("int").alias("FLAG_DOCUMENT_2"),
        ((k + 1) % 2).cast("int").alias("FLAG_DOCUMENT_3"),
        F.when(k % 12 == 0, None).otherwise((k % 2).cast("double")).alias("AMT_REQ_CREDIT_BUREAU_HOUR"),
        F.when(k % 12 == 0, None).otherwise((k % 3).cast("double")).alias("AMT_REQ_CREDIT_BUREAU_DAY"),
        F.when(k % 12 == 0, None).otherwise((k % 2).cast("double")).alias("AMT_REQ_CREDIT_BUREAU_WEEK"),
        F.when(k % 12 == 0, None).otherwise((k % 4).cast("double")).alias("AMT_REQ_CREDIT_BUREAU_MON"),
        F.when(k % 12 == 0, None).otherwise((k % 5).cast("double")).alias("AMT_REQ_CREDIT_BUREAU_QRT"),
        F.when(k % 12 == 0, None).otherwise((k % 6).cast("double")).alias("AMT_REQ_CREDIT_BUREAU_YEAR"),
    )


def bureau_from_orders(orders: DataFrame) -> DataFrame:
    k, p = F.col("o_orderkey"), F.col("o_totalprice")
    days = _days("o_orderdate")
    return orders.select(
        F.col("o_custkey").alias("SK_ID_CURR"), k.alias("SK_ID_BUREAU"),
        F.when(F.col("o_orderstatus") == "F", "Closed").when(F.col("o_orderstatus") == "O", "Active")
        .otherwise("Sold").alias("CREDIT_ACTIVE"),
        F.when(k % 9 == 0, "currency 2").otherwise("currency 1").alias("CREDIT_CURRENCY"),
        days.alias("DAYS_CREDIT"),
        F.when(k % 7 == 0, (k % 30).cast("int")).otherwise(0).alias("CREDIT_DAY_OVERDUE"),
        F.when(k % 19 == 0, None).otherwise(days + (k % 900).cast("int")).alias("DAYS_CREDIT_ENDDATE"),
        F.when(k % 5 == 0, None).otherwise(p / 100).alias("AMT_CREDIT_MAX_OVERDUE"),
        (k % 3).cast("int").alias("CNT_CREDIT_PROLONG"),
        p.alias("AMT_CREDIT_SUM"),
        (p * (k % 5) / 4).alias("AMT_CREDIT_SUM_DEBT"),
        F.when(k % 4 == 0, None).otherwise(p / 10).alias("AMT_CREDIT_SUM_LIMIT"),
        F.when(k % 6 == 0, p / 50).otherwise(0.0).alias("AMT_CREDIT_SUM_OVERDUE"),
        F.col("o_orderpriority").alias("CREDIT_TYPE"),
        (days + 30).alias("DAYS_CREDIT_UPDATE"),
        F.when(k % 8 == 0, 0.0).when(k % 8 == 1, None).otherwise(p / 12).alias("AMT_ANNUITY"),
    )


# Fixed mapping of lineitem line numbers onto balance statuses.
LINE_STATUS = ["0", "1", "C", "X", "2", "3", "5", "4"]


def bureau_balance_from_lineitem(lineitem: DataFrame) -> DataFrame:
    status = F.element_at(F.array(*[F.lit(s) for s in LINE_STATUS]),
                          (F.pmod(F.col("l_linenumber") - 1, F.lit(len(LINE_STATUS))) + 1).cast("int"))
    return lineitem.select(
        F.col("l_orderkey").alias("SK_ID_BUREAU"),
        F.floor(_days("l_shipdate") / 30).cast("int").alias("MONTHS_BALANCE"),
        F.when(F.col("l_returnflag") == "N", status).when(F.col("l_returnflag") == "A", "0")
        .otherwise(status).alias("STATUS"),
    )


def previous_from_orders(orders: DataFrame) -> DataFrame:
    k, p = F.col("o_orderkey"), F.col("o_totalprice")
    days = _days("o_orderdate")
    return orders.select(
        k.alias("SK_ID_PREV"), F.col("o_custkey").alias("SK_ID_CURR"),
        F.when(k % 2 == 0, "Cash loans").otherwise("Consumer loans").alias("NAME_CONTRACT_TYPE"),
        F.when(k % 10 == 0, 0.0).otherwise(p / 24).alias("AMT_ANNUITY"),
        (p * 1.1).alias("AMT_APPLICATION"),
        F.when(k % 25 == 0, 0.0).otherwise(p).alias("AMT_CREDIT"),
        F.when(k % 3 == 0, None).when(k % 3 == 1, 0.0).otherwise(p / 10).alias("AMT_DOWN_PAYMENT"),
        F.when(k % 4 == 0, None).otherwise(p * 0.95).alias("AMT_GOODS_PRICE"),
        F.concat(F.lit("DAY_"), (k % 7).cast("string")).alias("WEEKDAY_APPR_PROCESS_START"),
        (k % 24).cast("int").alias("HOUR_APPR_PROCESS_START"),
        F.when(F.col("o_orderstatus") == "F", "Approved").when(F.col("o_orderstatus") == "O", "Refused")
        .otherwise("Canceled").alias("NAME_CONTRACT_STATUS"),
        days.alias("DAYS_DECISION"),
        F.when(k % 6 == 0, None).otherwise(((k % 10) / 100.0)).alias("RATE_DOWN_PAYMENT"),
        F.when(k % 2 == 0, None).otherwise(((k % 7) / 50.0)).alias("RATE_INTEREST_PRIMARY"),
        F.when(k % 3 == 0, None).otherwise(((k % 9) / 50.0)).alias("RATE_INTEREST_PRIVILEGED"),
        F.col("o_orderpriority").alias("NAME_CASH_LOAN_PURPOSE"),
        F.when(k % 11 == 0, "XNA").otherwise(F.concat(F.lit("pay_"), (k % 3).cast("string"))).alias("NAME_PAYMENT_TYPE"),
        (12 + (k % 4) * 12).cast("double").alias("CNT_PAYMENT"),
        F.when(k % 5 == 0, None).otherwise((days - 30).cast("double")).alias("DAYS_FIRST_DRAWING"),
        (days + 30).cast("double").alias("DAYS_FIRST_DUE"),
        F.when(k % 9 == 0, 0.0).otherwise((days + 365).cast("double")).alias("DAYS_LAST_DUE_1ST_VERSION"),
        (days + 400).cast("double").alias("DAYS_LAST_DUE"),
        F.when(k % 13 == 0, 0.0).otherwise((days + 420).cast("double")).alias("DAYS_TERMINATION"),
    )


def _line_with_customer(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    if "o_custkey" in lineitem.columns:
        return lineitem
    return lineitem.join(orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"),
                         "l_orderkey", "inner")


def pos_from_lineitem(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    li = _line_with_customer(lineitem, orders)
    return li.select(
        F.col("l_orderkey").alias("SK_ID_PREV"), F.col("o_custkey").alias("SK_ID_CURR"),
        F.floor(_days("l_shipdate") / 30).cast("int").alias("MONTHS_BALANCE"),
        F.col("l_quantity").alias("CNT_INSTALMENT"),
        (F.col("l_quantity") - F.col("l_linenumber") * 5).alias("CNT_INSTALMENT_FUTURE"),
        F.when(F.col("l_returnflag") == "A", "Active").when(F.col("l_returnflag") == "R", "Completed")
        .otherwise("Signed").alias("NAME_CONTRACT_STATUS"),
        F.round(F.col("l_discount") * 100).cast("int").alias("SK_DPD"),
        F.round(F.col("l_tax") * 100).cast("int").alias("SK_DPD_DEF"),
    )


def installments_from_lineitem(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    li = _line_with_customer(lineitem, orders)
    due = _days("l_shipdate").cast("double")
    return li.select(
        F.col("l_orderkey").alias("SK_ID_PREV"), F.col("o_custkey").alias("SK_ID_CURR"),
        F.when(F.col("l_linestatus") == "F", 1.0).otherwise(0.0).alias("NUM_INSTALMENT_VERSION"),
        F.col("l_linenumber").alias("NUM_INSTALMENT_NUMBER"),
        F.when(F.col("l_partkey") % 29 == 0, None).otherwise(due).alias("DAYS_INSTALMENT"),
        F.when(F.col("l_suppkey") % 31 == 0, None).otherwise(due + (F.col("l_partkey") % 11) - 5)
        .alias("DAYS_ENTRY_PAYMENT"),
        F.col("l_extendedprice").alias("AMT_INSTALMENT"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("AMT_PAYMENT"),
    )


def card_from_events(events: DataFrame) -> DataFrame:
    v, e = F.col("value"), F.col("event_id")
    return events.select(
        (F.col("user_id") * 10 + F.when(F.col("event_type") == "purchase", 1).otherwise(0))
        .alias("SK_ID_PREV"),
        F.col("user_id").alias("SK_ID_CURR"),
        (-F.dayofmonth("ts")).cast("int").alias("MONTHS_BALANCE"),
        (v * 100).alias("AMT_BALANCE"),
        F.when(e % 9 == 0, 0.0).otherwise(v * 150).alias("AMT_CREDIT_LIMIT_ACTUAL"),
        F.when(e % 3 == 0, None).otherwise(v).alias("AMT_DRAWINGS_ATM_CURRENT"),
        (v * 2).alias("AMT_DRAWINGS_CURRENT"),
        F.when(e % 4 == 0, None).otherwise(v / 2).alias("AMT_DRAWINGS_OTHER_CURRENT"),
        (v / 3).alias("AMT_DRAWINGS_POS_CURRENT"),
        (v / 10).alias("AMT_INST_MIN_REGULARITY"),
        F.when(e % 7 == 0, None).otherwise(v * 1.5).alias("AMT_PAYMENT_CURRENT"),
        F.when(e % 11 == 0, 0.0).otherwise(v * 1.7).alias("AMT_PAYMENT_TOTAL_CURRENT"),
        (v * 90).alias("AMT_RECEIVABLE_PRINCIPAL"),
        F.when(e % 13 == 0, 0.0).otherwise(v * 95).alias("AMT_RECIVABLE"),
        F.when(e % 17 == 0, 0.0).otherwise(v * 96).alias("AMT_TOTAL_RECEIVABLE"),
        (e % 3).cast("double").alias("CNT_DRAWINGS_ATM_CURRENT"),
        (e % 4).cast("double").alias("CNT_DRAWINGS_CURRENT"),
        F.when(e % 5 == 0, None).otherwise((e % 2).cast("double")).alias("CNT_DRAWINGS_OTHER_CURRENT"),
        (e % 2).cast("double").alias("CNT_DRAWINGS_POS_CURRENT"),
        (e % 12).cast("double").alias("CNT_INSTALMENT_MATURE_CUM"),
        F.col("event_type").alias("NAME_CONTRACT_STATUS"),
        (e % 6).cast("int").alias("SK_DPD"),
        (e % 4).cast("int").alias("SK_DPD_DEF"),
    )


def domain_tables(spark: SparkSession, sf_dir: str, joined_once: bool = False) -> dict[str, DataFrame]:
    """``joined_once``: lines are joined to their borrowers in one job and written,
    for queries that read both tables made of them."""
    t = load_driver(spark, sf_dir, ["customer", "nation", "orders", "lineitem", "events"])
    lines = t["lineitem"]
    if joined_once:
        lines = write_table(_line_with_customer(lines, t["orders"]), "lines")
    return {
        "application": application_from_customer(t["customer"], t["nation"]),
        "bureau": bureau_from_orders(t["orders"]),
        "bureau_balance": bureau_balance_from_lineitem(t["lineitem"]),
        "previous_application": previous_from_orders(t["orders"]),
        "pos_cash": pos_from_lineitem(lines, t["orders"]),
        "installments": installments_from_lineitem(lines, t["orders"]),
        "credit_card": card_from_events(t["events"]),
    }
