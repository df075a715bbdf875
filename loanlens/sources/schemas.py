"""Explicit schemas of the eight domain tables (no CSV type inference).

Types: ids LONG, day/month offsets and counts INT, amounts DOUBLE,
categories STRING.  Columns not listed here are read as strings and can
be coerced with ``functions.coerce_numeric``.
"""

from __future__ import annotations

from pyspark.sql import types as T

L, I, D, S = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType()


def _st(*groups) -> T.StructType:
    fields = []
    for typ, names in groups:
        fields += [T.StructField(n, typ, True) for n in names.split()]
    return T.StructType(fields)


APPLICATION = _st(
    (L, "SK_ID_CURR"), (I, "TARGET"),
    (S, "NAME_CONTRACT_TYPE CODE_GENDER FLAG_OWN_CAR FLAG_OWN_REALTY NAME_TYPE_SUITE "
        "NAME_INCOME_TYPE NAME_EDUCATION_TYPE NAME_FAMILY_STATUS NAME_HOUSING_TYPE "
        "OCCUPATION_TYPE WEEKDAY_APPR_PROCESS_START ORGANIZATION_TYPE FONDKAPREMONT_MODE "
        "WALLSMATERIAL_MODE"),
    (I, "CNT_CHILDREN"),
    (D, "AMT_INCOME_TOTAL AMT_CREDIT AMT_ANNUITY AMT_GOODS_PRICE REGION_POPULATION_RELATIVE"),
    (I, "DAYS_BIRTH DAYS_EMPLOYED"), (D, "DAYS_REGISTRATION"), (I, "DAYS_ID_PUBLISH"),
    (D, "OWN_CAR_AGE CNT_FAM_MEMBERS"),
    (I, "REGION_RATING_CLIENT REGION_RATING_CLIENT_W_CITY REG_CITY_NOT_WORK_CITY"),
    (D, "EXT_SOURCE_1 EXT_SOURCE_2 EXT_SOURCE_3 APARTMENTS_AVG BASEMENTAREA_AVG "
        "YEARS_BUILD_AVG ELEVATORS_AVG FLOORSMAX_AVG LANDAREA_AVG LIVINGAPARTMENTS_AVG "
        "LIVINGAREA_AVG NONLIVINGAREA_AVG OBS_30_CNT_SOCIAL_CIRCLE DEF_30_CNT_SOCIAL_CIRCLE "
        "OBS_60_CNT_SOCIAL_CIRCLE DEF_60_CNT_SOCIAL_CIRCLE DAYS_LAST_PHONE_CHANGE"),
    (I, "FLAG_DOCUMENT_2 FLAG_DOCUMENT_3"),
    (D, "AMT_REQ_CREDIT_BUREAU_HOUR AMT_REQ_CREDIT_BUREAU_DAY AMT_REQ_CREDIT_BUREAU_WEEK "
        "AMT_REQ_CREDIT_BUREAU_MON AMT_REQ_CREDIT_BUREAU_QRT AMT_REQ_CREDIT_BUREAU_YEAR"),
)

BUREAU = _st(
    (L, "SK_ID_CURR SK_ID_BUREAU"), (S, "CREDIT_ACTIVE CREDIT_CURRENCY"),
    (I, "DAYS_CREDIT CREDIT_DAY_OVERDUE DAYS_CREDIT_ENDDATE"), (D, "DAYS_ENDDATE_FACT"),
    (D, "AMT_CREDIT_MAX_OVERDUE"), (I, "CNT_CREDIT_PROLONG"),
    (D, "AMT_CREDIT_SUM AMT_CREDIT_SUM_DEBT AMT_CREDIT_SUM_LIMIT AMT_CREDIT_SUM_OVERDUE"),
    (S, "CREDIT_TYPE"), (I, "DAYS_CREDIT_UPDATE"), (D, "AMT_ANNUITY"),
)

BUREAU_BALANCE = _st((L, "SK_ID_BUREAU"), (I, "MONTHS_BALANCE"), (S, "STATUS"))

PREVIOUS_APPLICATION = _st(
    (L, "SK_ID_PREV SK_ID_CURR"), (S, "NAME_CONTRACT_TYPE"),
    (D, "AMT_ANNUITY AMT_APPLICATION AMT_CREDIT AMT_DOWN_PAYMENT AMT_GOODS_PRICE"),
    (S, "WEEKDAY_APPR_PROCESS_START"), (I, "HOUR_APPR_PROCESS_START"),
    (S, "FLAG_LAST_APPL_PER_CONTRACT"), (I, "NFLAG_LAST_APPL_IN_DAY"),
    (D, "RATE_DOWN_PAYMENT RATE_INTEREST_PRIMARY RATE_INTEREST_PRIVILEGED"),
    (S, "NAME_CASH_LOAN_PURPOSE NAME_CONTRACT_STATUS"), (I, "DAYS_DECISION"),
    (S, "NAME_PAYMENT_TYPE CODE_REJECT_REASON NAME_TYPE_SUITE NAME_CLIENT_TYPE "
        "NAME_GOODS_CATEGORY NAME_PORTFOLIO NAME_PRODUCT_TYPE CHANNEL_TYPE"),
    (I, "SELLERPLACE_AREA"), (S, "NAME_SELLER_INDUSTRY"), (D, "CNT_PAYMENT"),
    (S, "NAME_YIELD_GROUP PRODUCT_COMBINATION"),
    (D, "DAYS_FIRST_DRAWING DAYS_FIRST_DUE DAYS_LAST_DUE_1ST_VERSION DAYS_LAST_DUE "
        "DAYS_TERMINATION NFLAG_INSURED_ON_APPROVAL"),
)

POS_CASH_BALANCE = _st(
    (L, "SK_ID_PREV SK_ID_CURR"), (I, "MONTHS_BALANCE"),
    (D, "CNT_INSTALMENT CNT_INSTALMENT_FUTURE"), (S, "NAME_CONTRACT_STATUS"),
    (I, "SK_DPD SK_DPD_DEF"),
)

INSTALLMENTS_PAYMENTS = _st(
    (L, "SK_ID_PREV SK_ID_CURR"), (D, "NUM_INSTALMENT_VERSION"), (I, "NUM_INSTALMENT_NUMBER"),
    (D, "DAYS_INSTALMENT DAYS_ENTRY_PAYMENT AMT_INSTALMENT AMT_PAYMENT"),
)

CREDIT_CARD_BALANCE = _st(
    (L, "SK_ID_PREV SK_ID_CURR"), (I, "MONTHS_BALANCE"),
    (D, "AMT_BALANCE AMT_CREDIT_LIMIT_ACTUAL AMT_DRAWINGS_ATM_CURRENT AMT_DRAWINGS_CURRENT "
        "AMT_DRAWINGS_OTHER_CURRENT AMT_DRAWINGS_POS_CURRENT AMT_INST_MIN_REGULARITY "
        "AMT_PAYMENT_CURRENT AMT_PAYMENT_TOTAL_CURRENT AMT_RECEIVABLE_PRINCIPAL AMT_RECIVABLE "
        "AMT_TOTAL_RECEIVABLE CNT_DRAWINGS_ATM_CURRENT CNT_DRAWINGS_CURRENT "
        "CNT_DRAWINGS_OTHER_CURRENT CNT_DRAWINGS_POS_CURRENT CNT_INSTALMENT_MATURE_CUM"),
    (S, "NAME_CONTRACT_STATUS"), (I, "SK_DPD SK_DPD_DEF"),
)

PREDICTIONS = _st((L, "SK_ID_CURR"), (D, "TARGET"))

# file stem -> (table name, schema)
DOMAIN_TABLES = {
    "application_train": ("application_train", APPLICATION),
    "application_test": ("application_test", APPLICATION),
    "bureau": ("bureau", BUREAU),
    "bureau_balance": ("bureau_balance", BUREAU_BALANCE),
    "previous_application": ("previous_application", PREVIOUS_APPLICATION),
    "POS_CASH_balance": ("pos_cash", POS_CASH_BALANCE),
    "installments_payments": ("installments", INSTALLMENTS_PAYMENTS),
    "credit_card_balance": ("credit_card", CREDIT_CARD_BALANCE),
}

# Category declarations per table (string columns treated as categories).
CATEGORICAL_COLUMNS = {
    "application": ["NAME_CONTRACT_TYPE", "CODE_GENDER", "FLAG_OWN_CAR", "FLAG_OWN_REALTY",
                    "NAME_INCOME_TYPE", "NAME_EDUCATION_TYPE", "NAME_FAMILY_STATUS",
                    "NAME_HOUSING_TYPE", "WEEKDAY_APPR_PROCESS_START", "ORGANIZATION_TYPE",
                    "NAME_TYPE_SUITE", "OCCUPATION_TYPE", "WALLSMATERIAL_MODE",
                    "FONDKAPREMONT_MODE"],
    "bureau": ["CREDIT_ACTIVE", "CREDIT_TYPE", "CREDIT_CURRENCY"],
    "bureau_balance": ["STATUS"],
    "pos_cash": ["NAME_CONTRACT_STATUS"],
}

# Every string column of the domain tables (other columns are numeric).
STRING_COLUMNS = frozenset(
    [f.name for st in (APPLICATION, BUREAU, BUREAU_BALANCE, PREVIOUS_APPLICATION, POS_CASH_BALANCE,
                       INSTALLMENTS_PAYMENTS, CREDIT_CARD_BALANCE)
     for f in st.fields if isinstance(f.dataType, T.StringType)]
    + ["HOUSETYPE_MODE", "EMERGENCYSTATE_MODE"])
