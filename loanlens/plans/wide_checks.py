"""Full-width SQL for the domain plans on the crosswalked driver tables.

The SQL is generated from spec tables of its own (``column: statistics``), not
from the plans' dictionaries, so a change of a plan shows.  Both sides pass
their numbers through the same rounding to six significant digits
(``canonical`` and ``_digits``): sums differ in their last bits by the order
of summation, and a shift of one part in 10^9 keeps exact ties off the edge.
Infinities become +-1e300 and what is left of a
difference of equals (below 1e-9) 0, on both sides.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanlens.sources.io import sanitize_name

_SHIFT, _DIGITS, _FAR, _NEAR = "1.000000001", 5, "1e300", "1e-9"


_POWERS = np.array([float(f"1e{k}") for k in range(309)])
_SLICE = 1 << 16


def six_digits(x: np.ndarray) -> np.ndarray:
    """Values of six significant digits; a value below ``_NEAR`` is 0, one beyond ``_FAR`` stays there, NaN stays."""
    near, far = float(_NEAR), float(_FAR)
    y = x * float(_SHIFT)
    size = np.abs(y)
    small, wide = np.abs(x) < near, size > far
    inner = np.where(small | wide | np.isnan(x), 1.0, size)
    places = _DIGITS - np.floor(np.log10(inner)).astype(np.int64)
    unit = _POWERS[np.abs(places)]
    # half up: there are six digits before the point, so the sum is exact
    up = np.where(places >= 0, np.floor(inner * np.where(places >= 0, unit, 1.0) + 0.5) / unit,
                  np.floor(inner / unit + 0.5) * np.where(places >= 0, 1.0, unit))
    out = np.copysign(np.where(wide, far, up), y)
    out[small] = 0.0
    out[np.isnan(x)] = np.nan
    return out


def canonical(df: DataFrame, key: str = "SK_ID_CURR") -> DataFrame:
    """Numbers of ``df`` as doubles of six significant digits.

    A frame has up to 1,100 of them, and an expression of this length for each
    is too much code to compile, so that a row took a millisecond: they are
    rounded by numpy, all numbers of a batch of rows at once."""
    numbers = [f.name for f in df.schema.fields if f.name != key and not isinstance(f.dataType, T.StringType)]
    if not numbers:
        return df

    @F.arrow_udf("array<double>")
    def rounded(rows: pa.Array) -> pa.Array:
        values = rows.flatten().to_numpy(zero_copy_only=False)
        out = np.empty(len(values))
        for at in range(0, len(values), _SLICE):
            out[at:at + _SLICE] = six_digits(values[at:at + _SLICE])
        offsets = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * len(numbers))
        return pa.ListArray.from_arrays(offsets, pa.array(out, from_pandas=True))

    place = {c: k for k, c in enumerate(numbers)}
    others = [F.col(f"`{c}`") for c in df.columns if c not in place]
    wide = df.select(*others, rounded(F.array(*[F.col(f"`{c}`").cast("double") for c in numbers])).alias("_values"))
    return wide.select(*[F.col("_values")[place[c]].alias(c) if c in place else F.col(f"`{c}`") for c in df.columns])


def _digits(x: str) -> str:
    y = f"(CAST({x} AS DOUBLE) * {_SHIFT})"
    places = f"({_DIGITS} - floor(log10(abs({y}))))"
    unit = f"pow(10.0, abs({places}))"
    return (f"CASE WHEN {y} IS NULL THEN NULL WHEN abs({y}) < {_NEAR} THEN 0.0 WHEN {y} > {_FAR} THEN {_FAR} "
            f"WHEN {y} < -{_FAR} THEN -{_FAR} WHEN {places} >= 0 THEN round({y} * {unit}) / {unit} "
            f"ELSE round({y} / {unit}) * {unit} END")


def _stat(x: str, stat: str, cond: str | None = None, far: bool = False) -> str:
    """One aggregate; NULL where no row meets ``cond``.  ``far``: the column may be infinite."""
    keep = f" FILTER (WHERE {cond})" if cond else ""
    if far and stat == "var":
        e = f"CASE WHEN count_if(abs({x}) > {_FAR}){keep} = 0 THEN var_samp(CASE WHEN abs({x}) <= {_FAR} THEN {x} END){keep} END"
    elif far and stat == "mean":
        plus, minus = (f"count_if({x} {s}{_FAR}){keep}" for s in ("> ", "< -"))
        e = (f"CASE WHEN {plus} > 0 AND {minus} > 0 THEN NULL WHEN {plus} > 0 THEN 1e301 WHEN {minus} > 0 THEN -1e301 "
             f"ELSE avg(CASE WHEN abs({x}) <= {_FAR} THEN {x} END){keep} END")
    else:
        e = {"min": f"min({x}){keep}", "max": f"max({x}){keep}", "mean": f"avg({x}){keep}",
             "sum": f"coalesce(sum({x}){keep}, 0)", "var": f"var_samp({x}){keep}", "std": f"stddev_samp({x}){keep}",
             "count": f"count({x}){keep}", "size": f"count(*){keep}", "nunique": f"count(DISTINCT {x}){keep}"}[stat]
    return f"CASE WHEN count(*){keep} > 0 THEN {e} END" if cond else e


def _spec(text: str) -> list[tuple[str, str]]:
    """``COLUMN: stat stat`` lines as (column, stat) pairs."""
    return [(c.strip(), s) for line in text.strip().splitlines() for c, stats in [line.split(":")] for s in stats.split()]


def _query(ctes: dict[str, str], out: list[tuple[str, str]], source: str, group: str | None) -> str:
    """SELECT with rounded columns; a leading ``=`` marks a column to return as it is."""
    inner = ",\n  ".join(f'{e.removeprefix("=")} AS "{n}"' for n, e in out)
    outer = ",\n  ".join(f'"{n}"' if e.startswith("=") else f'{_digits(chr(34) + n + chr(34))} AS "{n}"' for n, e in out)
    parts = ",\n".join(f"{name} AS ({sql})" for name, sql in ctes.items())
    tail = f" GROUP BY {group}" if group else ""
    return f"WITH {parts},\nwide AS (SELECT {inner}\nFROM {source}{tail})\nSELECT {outer} FROM wide"


def _days(c: str) -> str:
    return f"datediff('day', DATE '2002-01-01', CAST({c} AS DATE))"


def _over(a: str, b: str) -> str:
    return f"CASE WHEN {b} = 0 THEN NULL ELSE CAST({a} AS DOUBLE) / {b} END"


def _far_over(a: str, b: str) -> str:
    """IEEE quotient with 1e301 for an infinity."""
    return (f"CASE WHEN {b} = 0 THEN CASE WHEN {a} > 0 THEN 1e301 WHEN {a} < 0 THEN -1e301 END "
            f"ELSE CAST({a} AS DOUBLE) / {b} END")


def _codes(source: str, columns: list[str]) -> tuple[dict[str, str], str, list[str]]:
    """CTEs, joins and columns of the codes (rank of the sorted value, -1 for NULL) of string columns."""
    ctes, joins, out = {}, "", []
    for c in columns:
        name = f"codes_{c.lower()}"
        ctes[name] = (f"SELECT {c} AS v, row_number() OVER (ORDER BY {c}) - 1 AS code "
                      f"FROM (SELECT DISTINCT {c} FROM {source} WHERE {c} IS NOT NULL)")
        joins += f" LEFT JOIN {name} ON {source}.{c} = {name}.v"
        out.append(f"coalesce({name}.code, -1) AS {c}_CODE")
    return ctes, joins, out


# -- instalments --------------------------------------------------------------
_INSTALLMENTS = f"""
SELECT l.l_orderkey AS SK_ID_PREV, o.o_custkey AS SK_ID_CURR, l.l_linenumber AS NUM_INSTALMENT_NUMBER,
  CASE WHEN l.l_linestatus = 'F' THEN 1.0 ELSE 0.0 END AS NUM_INSTALMENT_VERSION,
  CASE WHEN l.l_partkey % 29 = 0 THEN NULL ELSE CAST({_days('l.l_shipdate')} AS DOUBLE) END AS DAYS_INSTALMENT,
  CASE WHEN l.l_suppkey % 31 = 0 THEN NULL
       ELSE CAST({_days('l.l_shipdate')} AS DOUBLE) + (l.l_partkey % 11) - 5 END AS DAYS_ENTRY_PAYMENT,
  l.l_extendedprice AS AMT_INSTALMENT, l.l_extendedprice * (1 - l.l_discount) AS AMT_PAYMENT
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"""
_INSTALLMENT_SPEC = _spec("""
NUM_INSTALMENT_VERSION: max nunique
DAYS_PAST_DUE: max mean sum
DAYS_BEFORE_DUE: max mean sum
DAYS_INSTALMENT: min
PCTG_PAYMENT: min max mean sum var
DIFF_PAYMENT: max mean sum var
AMT_INSTALMENT: max mean sum
AMT_PAYMENT: min max mean sum
DAYS_ENTRY_PAYMENT: min max mean sum
""")


def _moment_sql(c: str, order: int) -> str:
    """Population skewness (3) or excess kurtosis (4) from central moments."""
    m2 = f"avg(({c} - {c}_M) * ({c} - {c}_M))"
    if order == 3:
        return (f"CASE WHEN count(*) >= 3 AND {m2} > 0 THEN avg(({c} - {c}_M) * ({c} - {c}_M) * ({c} - {c}_M)) "
                f"/ pow({m2}, 1.5) END")
    return (f"CASE WHEN count(*) >= 4 AND {m2} > 0 THEN avg(pow({c} - {c}_M, 4)) / ({m2} * {m2}) - 3 END")


def installments_sql() -> str:
    tail = "_(INSTALL_PAY)"
    moments = ["AMT_PAYMENT", "AMT_INSTALMENT", "DAYS_ENTRY_PAYMENT"]
    means = ", ".join(f"avg({c}) AS {c}_M" for c in moments)
    ctes = {"x": _INSTALLMENTS,
            "y": """SELECT *, CASE WHEN DAYS_ENTRY_PAYMENT - DAYS_INSTALMENT IS NOT NULL
                         THEN greatest(DAYS_ENTRY_PAYMENT - DAYS_INSTALMENT, 0) END AS DAYS_PAST_DUE,
                    CASE WHEN DAYS_ENTRY_PAYMENT - DAYS_INSTALMENT IS NOT NULL
                         THEN greatest(DAYS_INSTALMENT - DAYS_ENTRY_PAYMENT, 0) END AS DAYS_BEFORE_DUE,
                    AMT_PAYMENT / (AMT_INSTALMENT + 1e-8) AS PCTG_PAYMENT, AMT_INSTALMENT - AMT_PAYMENT AS DIFF_PAYMENT,
                    AMT_PAYMENT / (AMT_INSTALMENT + 1e-10) AS RATIO FROM x""",
            "m": f"SELECT SK_ID_CURR AS k, {means} FROM y GROUP BY SK_ID_CURR",
            "last": """SELECT SK_ID_CURR AS k, NUM_INSTALMENT_VERSION AS version FROM (
                         SELECT *, row_number() OVER (PARTITION BY SK_ID_CURR ORDER BY DAYS_INSTALMENT DESC NULLS FIRST,
                           NUM_INSTALMENT_NUMBER DESC, SK_ID_PREV DESC, NUM_INSTALMENT_VERSION DESC) AS rn FROM y) WHERE rn = 1"""}
    out = [("SK_ID_CURR", "=SK_ID_CURR")]
    out += [(f"{c}_{s.upper()}{tail}", _stat(c, s)) for c, s in _INSTALLMENT_SPEC]
    out += [(f"COUNT_INSTALLMENTS_PAID{tail}", "count(NUM_INSTALMENT_NUMBER)"),
            (f"COUNT_INSTALLMENTS_ACCTS_CAT{tail}", "count(DISTINCT SK_ID_PREV)")]
    for c in moments:
        out += [(f"{c}_SAFE_SKEW{tail}", _moment_sql(c, 3)), (f"{c}_SAFE_KURT{tail}", _moment_sql(c, 4))]
    for name, c in (("PAYMENT_AMOUNT_CV", "AMT_PAYMENT"), ("PAYMENT_RATIO_CV", "RATIO")):
        out.append((name + tail, f"CASE WHEN abs(avg({c})) >= 1e-10 THEN stddev_samp({c}) / avg({c}) END"))
    out.append((f"INSTALMENT_VERSION_LAST_DUE_CAT{tail}", "max(last.version)"))
    return _query(ctes, out, "y JOIN m ON y.SK_ID_CURR = m.k JOIN last ON y.SK_ID_CURR = last.k", "SK_ID_CURR")


# -- point of sale ------------------------------------------------------------
_POS = f"""
SELECT l.l_orderkey AS SK_ID_PREV, o.o_custkey AS SK_ID_CURR,
  CAST(floor({_days('l.l_shipdate')} / 30) AS INTEGER) AS MONTHS_BALANCE, l.l_quantity AS CNT_INSTALMENT,
  l.l_quantity - l.l_linenumber * 5 AS CNT_INSTALMENT_FUTURE,
  CASE l.l_returnflag WHEN 'A' THEN 'Active' WHEN 'R' THEN 'Completed' ELSE 'Signed' END AS STATUS,
  CAST(round(l.l_discount * 100) AS INTEGER) AS SK_DPD, CAST(round(l.l_tax * 100) AS INTEGER) AS SK_DPD_DEF
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"""
_POS_SPEC = _spec("""
MONTHS_BALANCE: max mean size
SK_DPD: max mean sum
SK_DPD_DEF: max mean sum
CNT_INSTALMENT_FUTURE: mean sum
CNT_INSTALMENT: max mean
NAME_CONTRACT_STATUS: mean
RATIO_SK_DPD_TO_CNT_INSTALMENT_FUTURE: min max mean
RATIO_SK_DPD_DEF_TO_CNT_INSTALMENT_FUTURE: min max mean
RATIO_SK_DPD_TO_CNT_INSTALMENT: min max mean
RATIO_SK_DPD_DEF_TO_CNT_INSTALMENT: min max mean
RATIO_CNT_INSTALMENT_TO_CNT_INSTALMENT_FUTURE: min max mean
DIFF_CNT_INSTALMENT_FUTURE_CNT_INSTALMENT: min max mean
""")


def pos_sql() -> str:
    tail = "_(POS_CASH)"
    codes, joins, extra = _codes("x", ["STATUS"])
    ratios = [f"{_over(a, b)} AS RATIO_{a}_TO_{b}" for a, b in (
        ("SK_DPD", "CNT_INSTALMENT_FUTURE"), ("SK_DPD_DEF", "CNT_INSTALMENT_FUTURE"), ("SK_DPD", "CNT_INSTALMENT"),
        ("SK_DPD_DEF", "CNT_INSTALMENT"), ("CNT_INSTALMENT", "CNT_INSTALMENT_FUTURE"))]
    ctes = {"x": _POS, **codes,
            "y": f"SELECT x.*, {', '.join(ratios)}, {extra[0].replace('STATUS_CODE', 'NAME_CONTRACT_STATUS')}, "
                 f"CNT_INSTALMENT_FUTURE - CNT_INSTALMENT AS DIFF_CNT_INSTALMENT_FUTURE_CNT_INSTALMENT FROM x{joins}",
            "last": """SELECT SK_ID_CURR, STATUS FROM (SELECT *, row_number() OVER (PARTITION BY SK_ID_PREV
                         ORDER BY MONTHS_BALANCE DESC, SK_ID_CURR DESC, STATUS DESC) AS rn FROM x) WHERE rn = 1""",
            "recent": """SELECT SK_ID_CURR AS k, count(*) FILTER (WHERE STATUS = 'Completed') AS c,
                                count(*) FILTER (WHERE STATUS = 'Signed') AS s FROM last GROUP BY SK_ID_CURR""",
            "agg": "SELECT SK_ID_CURR, " + ", ".join(f'{_stat(c, s)} AS "{c}_{s}"' for c, s in _POS_SPEC)
                   + ", count(DISTINCT SK_ID_PREV) AS loans FROM y GROUP BY SK_ID_CURR"}
    out = [("SK_ID_CURR", "=customer.c_custkey")]
    out += [(f"{c}_{s.upper()}{tail}", f'coalesce("{c}_{s}", 0)') for c, s in _POS_SPEC]
    out += [(f"COUNT_POS_CASH_LOANS{tail}", "coalesce(loans, 0)"), (f"COUNT_POS_CASH_LOANS_CAT{tail}", "coalesce(loans, 0)"),
            ("POS_CASH_COUNT_COMPLETED_LAST_MONTH", "coalesce(recent.c, 0)"),
            ("POS_CASH_COUNT_SIGNED_LAST_MONTH", "coalesce(recent.s, 0)")]
    return _query(ctes, out, "customer LEFT JOIN agg ON c_custkey = agg.SK_ID_CURR LEFT JOIN recent ON c_custkey = recent.k", None)


# -- credit card --------------------------------------------------------------
_CARD = """
SELECT user_id AS SK_ID_CURR, user_id * 10 + CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS SK_ID_PREV,
  -dayofmonth(ts) AS MONTHS_BALANCE, value * 100 AS AMT_BALANCE,
  CASE WHEN event_id % 9 = 0 THEN 0.0 ELSE value * 150 END AS AMT_CREDIT_LIMIT_ACTUAL,
  CASE WHEN event_id % 3 = 0 THEN NULL ELSE value END AS AMT_DRAWINGS_ATM_CURRENT, value * 2 AS AMT_DRAWINGS_CURRENT,
  CASE WHEN event_id % 4 = 0 THEN NULL ELSE value / 2 END AS AMT_DRAWINGS_OTHER_CURRENT,
  value / 3 AS AMT_DRAWINGS_POS_CURRENT, value / 10 AS AMT_INST_MIN_REGULARITY,
  CASE WHEN event_id % 7 = 0 THEN NULL ELSE value * 1.5 END AS AMT_PAYMENT_CURRENT,
  CASE WHEN event_id % 11 = 0 THEN 0.0 ELSE value * 1.7 END AS AMT_PAYMENT_TOTAL_CURRENT,
  value * 90 AS AMT_RECEIVABLE_PRINCIPAL, CASE WHEN event_id % 13 = 0 THEN 0.0 ELSE value * 95 END AS AMT_RECIVABLE,
  CASE WHEN event_id % 17 = 0 THEN 0.0 ELSE value * 96 END AS AMT_TOTAL_RECEIVABLE,
  CAST(event_id % 3 AS DOUBLE) AS CNT_DRAWINGS_ATM_CURRENT, CAST(event_id % 4 AS DOUBLE) AS CNT_DRAWINGS_CURRENT,
  CASE WHEN event_id % 5 = 0 THEN NULL ELSE CAST(event_id % 2 AS DOUBLE) END AS CNT_DRAWINGS_OTHER_CURRENT,
  CAST(event_id % 2 AS DOUBLE) AS CNT_DRAWINGS_POS_CURRENT, CAST(event_id % 12 AS DOUBLE) AS CNT_INSTALMENT_MATURE_CUM,
  event_type AS NAME_CONTRACT_STATUS, event_id % 6 AS SK_DPD, event_id % 4 AS SK_DPD_DEF
FROM events"""
_CARD_SPEC = _spec("""
MONTHS_BALANCE: min max size
AMT_BALANCE: min max mean sum
AMT_CREDIT_LIMIT_ACTUAL: min max mean sum var
AMT_DRAWINGS_ATM_CURRENT: max
AMT_DRAWINGS_CURRENT: max
AMT_DRAWINGS_OTHER_CURRENT: max
AMT_DRAWINGS_POS_CURRENT: max
AMT_INST_MIN_REGULARITY: max
AMT_PAYMENT_CURRENT: max
AMT_PAYMENT_TOTAL_CURRENT: max
AMT_RECEIVABLE_PRINCIPAL: mean sum
AMT_RECIVABLE: mean sum
AMT_TOTAL_RECEIVABLE: mean
CNT_DRAWINGS_ATM_CURRENT: max
CNT_DRAWINGS_CURRENT: max
CNT_DRAWINGS_OTHER_CURRENT: max
CNT_DRAWINGS_POS_CURRENT: max
CNT_INSTALMENT_MATURE_CUM: mean sum
SK_DPD: max sum
SK_DPD_DEF: max sum
NAME_CONTRACT_STATUS_CODE: mean
RATIO_AMT_BALANCE_TO_AMT_CREDIT_LIMIT_ACTUAL: min max mean
SUM_ALL_AMT_DRAWINGS: min max mean
RATIO_AMT_PAYMENT_TOTAL_CURRENT_TO_AMT_TOTAL_RECEIVABLE: min max mean
RATIO_AMT_PAYMENT_CURRENT_TO_AMT_RECIVABLE: min max mean
SUM_ALL_CNT_DRAWINGS: min max mean
RATIO_ALL_AMT_DRAWINGS_TO_ALL_CNT_DRAWINGS: min max mean
DIFF_AMT_TOTAL_RECEIVABLE_AMT_PAYMENT_TOTAL_CURRENT: min max mean
RATIO_AMT_PAYMENT_CURRENT_TO_AMT_PAYMENT_TOTAL_CURRENT: min max mean
RATIO_AMT_RECEIVABLE_PRINCIPAL_TO_AMT_RECIVABLE: min max mean
""")


def card_sql() -> str:
    tail = "_(CREDIT_CARD)"
    codes, joins, extra = _codes("x", ["NAME_CONTRACT_STATUS"])
    draws = {k: " + ".join(f"coalesce({k}_DRAWINGS_{p}CURRENT, 0)" for p in ("ATM_", "", "OTHER_", "POS_")) for k in ("AMT", "CNT")}
    ratios = [f"{_over(a, b)} AS RATIO_{a}_TO_{b}" for a, b in (
        ("AMT_BALANCE", "AMT_CREDIT_LIMIT_ACTUAL"), ("AMT_PAYMENT_TOTAL_CURRENT", "AMT_TOTAL_RECEIVABLE"),
        ("AMT_PAYMENT_CURRENT", "AMT_RECIVABLE"), ("AMT_PAYMENT_CURRENT", "AMT_PAYMENT_TOTAL_CURRENT"),
        ("AMT_RECEIVABLE_PRINCIPAL", "AMT_RECIVABLE"))]
    ctes = {"x": _CARD, **codes,
            "y": f"SELECT x.*, {', '.join(ratios)}, {extra[0]}, {draws['AMT']} AS SUM_ALL_AMT_DRAWINGS, "
                 f"{draws['CNT']} AS SUM_ALL_CNT_DRAWINGS, AMT_TOTAL_RECEIVABLE - AMT_PAYMENT_TOTAL_CURRENT "
                 f"AS DIFF_AMT_TOTAL_RECEIVABLE_AMT_PAYMENT_TOTAL_CURRENT FROM x{joins}",
            "z": f"SELECT *, {_over('SUM_ALL_AMT_DRAWINGS', 'SUM_ALL_CNT_DRAWINGS')} "
                 "AS RATIO_ALL_AMT_DRAWINGS_TO_ALL_CNT_DRAWINGS FROM y"}
    out = [("SK_ID_CURR", "=SK_ID_CURR")] + [(f"{c}_{s.upper()}{tail}", _stat(c, s)) for c, s in _CARD_SPEC]
    out.append((f"COUNT_CREDIT_CARD_LOANS{tail}", "count(DISTINCT SK_ID_PREV)"))
    return _query(ctes, out, "z", "SK_ID_CURR")


# -- previous applications ----------------------------------------------------
_PREVIOUS = f"""
SELECT o_orderkey AS SK_ID_PREV, o_custkey AS SK_ID_CURR,
  CASE WHEN o_orderkey % 2 = 0 THEN 'Cash loans' ELSE 'Consumer loans' END AS NAME_CONTRACT_TYPE,
  CASE WHEN o_orderkey % 10 = 0 THEN 0.0 ELSE o_totalprice / 24 END AS AMT_ANNUITY, o_totalprice * 1.1 AS AMT_APPLICATION,
  CASE WHEN o_orderkey % 25 = 0 THEN 0.0 ELSE o_totalprice END AS AMT_CREDIT,
  CASE WHEN o_orderkey % 3 = 0 THEN NULL WHEN o_orderkey % 3 = 1 THEN 0.0 ELSE o_totalprice / 10 END AS AMT_DOWN_PAYMENT,
  CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_totalprice * 0.95 END AS AMT_GOODS_PRICE,
  'DAY_' || CAST(o_orderkey % 7 AS VARCHAR) AS WEEKDAY_APPR_PROCESS_START, o_orderkey % 24 AS HOUR_APPR_PROCESS_START,
  CASE o_orderstatus WHEN 'F' THEN 'Approved' WHEN 'O' THEN 'Refused' ELSE 'Canceled' END AS NAME_CONTRACT_STATUS,
  {_days('o_orderdate')} AS DAYS_DECISION,
  CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE (o_orderkey % 10) / 100.0 END AS RATE_DOWN_PAYMENT,
  CASE WHEN o_orderkey % 2 = 0 THEN NULL ELSE (o_orderkey % 7) / 50.0 END AS RATE_INTEREST_PRIMARY,
  CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE (o_orderkey % 9) / 50.0 END AS RATE_INTEREST_PRIVILEGED,
  o_orderpriority AS NAME_CASH_LOAN_PURPOSE,
  CASE WHEN o_orderkey % 11 = 0 THEN 'XNA' ELSE 'pay_' || CAST(o_orderkey % 3 AS VARCHAR) END AS NAME_PAYMENT_TYPE,
  CAST(12 + (o_orderkey % 4) * 12 AS DOUBLE) AS CNT_PAYMENT,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST({_days('o_orderdate')} - 30 AS DOUBLE) END AS DAYS_FIRST_DRAWING,
  CAST({_days('o_orderdate')} + 30 AS DOUBLE) AS DAYS_FIRST_DUE,
  CASE WHEN o_orderkey % 9 = 0 THEN 0.0 ELSE CAST({_days('o_orderdate')} + 365 AS DOUBLE) END AS DAYS_LAST_DUE_1ST_VERSION,
  CAST({_days('o_orderdate')} + 400 AS DOUBLE) AS DAYS_LAST_DUE,
  CASE WHEN o_orderkey % 13 = 0 THEN 0.0 ELSE CAST({_days('o_orderdate')} + 420 AS DOUBLE) END AS DAYS_TERMINATION
FROM orders"""
_PREVIOUS_RATIOS = [
    ("AMT_APPLICATION", "AMT_CREDIT"), ("AMT_CREDIT", "AMT_ANNUITY"), ("AMT_APPLICATION", "AMT_ANNUITY"),
    ("AMT_CREDIT", "AMT_DOWN_PAYMENT"), ("DAYS_LAST_DUE", "DAYS_LAST_DUE_1ST_VERSION"), ("DAYS_DECISION", "DAYS_TERMINATION")]
_PREVIOUS_DIFFS = [
    ("AMT_DOWN_PAYMENT", "AMT_ANNUITY"), ("AMT_CREDIT", "AMT_GOODS_PRICE"), ("AMT_APPLICATION", "AMT_GOODS_PRICE"),
    ("RATE_DOWN_PAYMENT", "RATE_INTEREST_PRIMARY"), ("RATE_INTEREST_PRIVILEGED", "RATE_INTEREST_PRIMARY"),
    ("DAYS_LAST_DUE", "DAYS_FIRST_DUE"), ("DAYS_TERMINATION", "DAYS_DECISION")]
_PREVIOUS_SPEC = _spec("\n".join(
    [f"{c}: min max mean" for c in (
        "AMT_ANNUITY AMT_APPLICATION AMT_CREDIT AMT_DOWN_PAYMENT AMT_GOODS_PRICE HOUR_APPR_PROCESS_START RATE_DOWN_PAYMENT "
        "RATE_INTEREST_PRIMARY RATE_INTEREST_PRIVILEGED DAYS_DECISION DAYS_FIRST_DRAWING DAYS_FIRST_DUE "
        "DAYS_LAST_DUE_1ST_VERSION DAYS_LAST_DUE DAYS_TERMINATION").split()]
    + ["CNT_PAYMENT: mean sum"] + [f"RATIO_{a}_TO_{b}: min max mean var" for a, b in _PREVIOUS_RATIOS]
    + [f"DIFF_{a}_{b}: min max mean var" for a, b in _PREVIOUS_DIFFS]))
_PREVIOUS_CODES = ["NAME_CONTRACT_TYPE", "WEEKDAY_APPR_PROCESS_START", "NAME_CASH_LOAN_PURPOSE", "NAME_CONTRACT_STATUS",
                   "NAME_PAYMENT_TYPE"]


def _bins(n: str) -> str:
    return (f"CASE WHEN {n} = 1 THEN '1' WHEN {n} BETWEEN 2 AND 3 THEN '2-3' WHEN {n} BETWEEN 4 AND 5 THEN '4-5' "
            f"WHEN {n} BETWEEN 6 AND 10 THEN '6-10' WHEN {n} BETWEEN 11 AND 1000 THEN '>10' END")


def previous_sql() -> str:
    codes, joins, extra = _codes("x", _PREVIOUS_CODES)
    derived = [f"{_far_over(a, b)} AS RATIO_{a}_TO_{b}" for a, b in _PREVIOUS_RATIOS]
    derived += [f"CAST({a} AS DOUBLE) - {b} AS DIFF_{a}_{b}" for a, b in _PREVIOUS_DIFFS]
    far = {f"RATIO_{a}_TO_{b}" for a, b in _PREVIOUS_RATIOS}
    aggs = []
    for tail, cond in (("", None), ("_APPROVED", "NAME_CONTRACT_STATUS = 'Approved'"),
                       ("_REFUSED", "NAME_CONTRACT_STATUS = 'Refused'")):
        aggs += [(f"PREV_{c}_{s.upper()}{tail}", _stat(c, s, cond, c in far)) for c, s in _PREVIOUS_SPEC]
    aggs += [(f"PREV_{c}_CODE_MEAN", f"avg({c}_CODE)") for c in _PREVIOUS_CODES]
    counts = [("TOTAL", "count(DISTINCT SK_ID_PREV)")] + [
        (s.upper(), f"count(DISTINCT SK_ID_PREV) FILTER (WHERE NAME_CONTRACT_STATUS = '{s}')")
        for s in ("Approved", "Refused", "Canceled")]
    aggs += [(f"PREV_COUNT_{n}_PREV_APP_LOANS", e) for n, e in counts]
    ctes = {"x": _PREVIOUS, **codes, "y": f"SELECT x.*, {', '.join(derived)}, {', '.join(extra)} FROM x{joins}",
            "agg": "SELECT SK_ID_CURR, " + ",\n".join(f'{e} AS "{n}"' for n, e in aggs) + " FROM y GROUP BY SK_ID_CURR"}
    out = [("SK_ID_CURR", "=SK_ID_CURR")] + [(n, f'coalesce("{n}", 0)') for n, _ in aggs]
    # no approved loan at all leaves the count, and so its bin, empty
    out += [(f"PREV_COUNT_{n}_PREV_APP_LOANS_CAT", "=" + _bins(f'"PREV_COUNT_{n}_PREV_APP_LOANS"')) for n in ("TOTAL", "APPROVED")]
    return _query(ctes, out, "agg", None)


# -- bureau -------------------------------------------------------------------
_BUREAU = f"""
SELECT o_custkey AS SK_ID_CURR, o_orderkey AS SK_ID_BUREAU,
  CASE o_orderstatus WHEN 'F' THEN 'Closed' WHEN 'O' THEN 'Active' ELSE 'Sold' END AS CREDIT_ACTIVE,
  CASE WHEN o_orderkey % 9 = 0 THEN 'currency 2' ELSE 'currency 1' END AS CREDIT_CURRENCY, o_orderpriority AS CREDIT_TYPE,
  {_days('o_orderdate')} AS DAYS_CREDIT,
  CASE WHEN o_orderkey % 7 = 0 THEN o_orderkey % 30 ELSE 0 END AS CREDIT_DAY_OVERDUE,
  CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE {_days('o_orderdate')} + o_orderkey % 900 END AS DAYS_CREDIT_ENDDATE,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_totalprice / 100 END AS AMT_CREDIT_MAX_OVERDUE,
  o_orderkey % 3 AS CNT_CREDIT_PROLONG, o_totalprice AS AMT_CREDIT_SUM,
  o_totalprice * (o_orderkey % 5) / 4 AS AMT_CREDIT_SUM_DEBT,
  CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_totalprice / 10 END AS AMT_CREDIT_SUM_LIMIT,
  CASE WHEN o_orderkey % 6 = 0 THEN o_totalprice / 50 ELSE 0.0 END AS AMT_CREDIT_SUM_OVERDUE,
  {_days('o_orderdate')} + 30 AS DAYS_CREDIT_UPDATE,
  CASE WHEN o_orderkey % 8 = 0 THEN 0.0 WHEN o_orderkey % 8 = 1 THEN NULL ELSE o_totalprice / 12 END AS AMT_ANNUITY
FROM orders"""
_BALANCE = f"""
SELECT l_orderkey AS SK_ID_BUREAU, CAST(floor({_days('l_shipdate')} / 30) AS INTEGER) AS MONTHS_BALANCE,
  CASE WHEN l_returnflag = 'A' THEN '0'
       ELSE CASE (l_linenumber - 1) % 8 WHEN 0 THEN '0' WHEN 1 THEN '1' WHEN 2 THEN 'C' WHEN 3 THEN 'X' WHEN 4 THEN '2'
                 WHEN 5 THEN '3' WHEN 6 THEN '5' ELSE '4' END END AS STATUS
FROM lineitem"""
STATUSES = ["0", "1", "2", "3", "4", "5", "C", "X"]


def balance_sql() -> str:
    """Every column of the loan-level roll-up of the balance rows."""
    tail = "_(BB)"
    out = [("SK_ID_BUREAU", "=SK_ID_BUREAU"), ("MONTHS_BALANCE_SIZE", "count(*)")]
    out += [(f"MONTHS_BALANCE_BY_LOAN_{s.upper()}{tail}", _stat("MONTHS_BALANCE", s)) for s in ("min", "max", "mean", "std", "sum")]
    out += [(f"DPD_COUNT_BY_LOAN_SUM{tail}", "sum(CASE WHEN STATUS IN ('2', '3', '4', '5') THEN 1 ELSE 0 END)"),
            (f"STATUS_BY_LOAN_NUNIQUE{tail}", "count(DISTINCT STATUS)")]
    out += [(f"BBalance_STATUS_{v}_BY_LOAN_MEAN{tail}", f"avg(CASE WHEN STATUS = '{v}' THEN 1.0 ELSE 0.0 END)")
            for v in STATUSES if v != "4"]  # lines are numbered 1 to 7, so the eighth status never comes
    return _query({"x": _BALANCE}, out, "x", "SK_ID_BUREAU")


_DERIVED = """MONTHS_BALANCE_SIZE: mean sum
DIFF_DAYS_CREDIT_ENDDATE_DAYS_CREDIT: mean max
RATIO_AMT_CREDIT_SUM_TO_AMT_CREDIT_SUM_DEBT: mean max min
RATIO_AMT_CREDIT_SUM_TO_AMT_ANNUITY: mean max min
DIFF_AMT_CREDIT_SUM_DEBT_AMT_ANNUITY: mean max min
RATIO_AMT_CREDIT_SUM_DEBT_AMT_CREDIT_SUM: mean max min
"""
_BUREAU_ALL = _spec("""
SK_ID_BUREAU: count
DAYS_CREDIT: min max mean var
DAYS_CREDIT_ENDDATE: min max mean
DAYS_CREDIT_UPDATE: mean
CREDIT_DAY_OVERDUE: max mean
AMT_CREDIT_MAX_OVERDUE: max mean
AMT_CREDIT_SUM: max mean sum
AMT_CREDIT_SUM_DEBT: max mean sum
AMT_CREDIT_SUM_LIMIT: mean sum
AMT_CREDIT_SUM_OVERDUE: mean sum
AMT_ANNUITY: max mean
CNT_CREDIT_PROLONG: sum
""" + _DERIVED)
_BUREAU_PART = _spec("""
DAYS_CREDIT: min max mean
DAYS_CREDIT_ENDDATE: min max
AMT_CREDIT_MAX_OVERDUE: max mean
AMT_CREDIT_SUM: mean sum
AMT_CREDIT_SUM_DEBT: mean sum
AMT_CREDIT_SUM_OVERDUE: mean
AMT_CREDIT_SUM_LIMIT: mean sum
AMT_ANNUITY: max mean
CNT_CREDIT_PROLONG: sum
""" + _DERIVED)
_ACTIVE, _CLOSED = "CREDIT_ACTIVE = 'Active'", "CREDIT_ACTIVE = 'Closed'"
# fixed values of the crosswalk
_ACTIVE_VALUES = ["Active", "Closed", "Sold"]
_CURRENCIES = ["currency 1", "currency 2"]
_PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def _dummy(c: str, v: str) -> str:
    return f"CASE WHEN {c} = '{v}' THEN 1.0 ELSE 0.0 END"


def bureau_sql() -> str:
    tail = "_(BUREAU)"
    cats = ["CREDIT_ACTIVE", "CREDIT_CURRENCY", "CREDIT_TYPE"]
    codes, joins, extra = _codes("x", cats)
    ratios = [f"{_over(a, b)} AS RATIO_{n}" for n, a, b in (
        ("AMT_CREDIT_SUM_TO_AMT_CREDIT_SUM_DEBT", "AMT_CREDIT_SUM", "AMT_CREDIT_SUM_DEBT"),
        ("AMT_CREDIT_SUM_TO_AMT_ANNUITY", "AMT_CREDIT_SUM", "AMT_ANNUITY"),
        ("AMT_CREDIT_SUM_DEBT_AMT_CREDIT_SUM", "AMT_CREDIT_SUM_DEBT", "AMT_CREDIT_SUM"))]
    aggs = [(f"BUREAU_{c}_{s.upper()}", _stat(c, s)) for c, s in _BUREAU_ALL]
    for kind, cond in (("ACTIVE", _ACTIVE), ("CLOSED", _CLOSED)):
        aggs += [(f"BUREAU_{kind}_{c}_{s.upper()}", _stat(c, s, cond)) for c, s in _BUREAU_PART]
    late = "sum(CASE WHEN CREDIT_DAY_OVERDUE > 0 THEN 1 ELSE 0 END)"
    aggs += [(f"BUREAU_CAT_{c}_{c}_CODE_MEAN", f"avg({c}_CODE)") for c in cats]
    aggs += [(f"COUNT_CREDIT_BUREAU_LOANS_OVERDUE{tail}", late),
             (f"HAS_CREDIT_BUREAU_LOANS_OVERDUE{tail}", f"CASE WHEN {late} > 0 THEN 1 ELSE 0 END")]
    aggs += [(f"CAT_OHE_MEAN_{c}_{v}{tail}", f"avg({_dummy(c, v)})")
             for c, values in (("CREDIT_ACTIVE", _ACTIVE_VALUES), ("CREDIT_TYPE", _PRIORITIES)) for v in values]
    # a group with a missing value has no quantile
    aggs += [(f"BUREAU_{c}_QUANTILE{tail}", f"CASE WHEN count({c}) = count(*) THEN quantile_cont({c}, {q}) END")
             for c, q in (("DAYS_CREDIT", 0.25), ("AMT_CREDIT_SUM", 0.25), ("AMT_CREDIT_SUM_DEBT", 0.75))]
    latest = ", ".join(f"{c} AS LATEST_{c}" for c in cats)
    ctes = {"bb": "SELECT l_orderkey AS k, count(*) AS n FROM lineitem GROUP BY l_orderkey", "x": _BUREAU, **codes,
            "y": f"SELECT x.*, coalesce(bb.n, 0) AS MONTHS_BALANCE_SIZE, {', '.join(ratios)}, {', '.join(extra)}, "
                 "DAYS_CREDIT_ENDDATE - DAYS_CREDIT AS DIFF_DAYS_CREDIT_ENDDATE_DAYS_CREDIT, "
                 "AMT_CREDIT_SUM_DEBT - AMT_ANNUITY AS DIFF_AMT_CREDIT_SUM_DEBT_AMT_ANNUITY "
                 f"FROM x LEFT JOIN bb ON x.SK_ID_BUREAU = bb.k{joins}",
            "latest": f"SELECT SK_ID_CURR AS k, {latest} FROM (SELECT *, row_number() OVER (PARTITION BY SK_ID_CURR "
                      "ORDER BY DAYS_CREDIT DESC, SK_ID_BUREAU) AS rn FROM x) WHERE rn = 1",
            "agg": "SELECT SK_ID_CURR, " + ",\n".join(f'{e} AS "{n}"' for n, e in aggs) + " FROM y GROUP BY SK_ID_CURR"}
    out = [("SK_ID_CURR", "=SK_ID_CURR")] + [(n, f'"{n}"') for n, _ in aggs]
    for c, s in _BUREAU_PART:
        a, b = f"BUREAU_ACTIVE_{c}_{s.upper()}", f"BUREAU_CLOSED_{c}_{s.upper()}"
        out.append((f"RATIO_{a}_TO_{b}", _over(f'"{a}"', f'"{b}"')))
    out += [(f"LATEST_{c}_CAT{tail}", f"=LATEST_{c}") for c in cats]
    return _query(ctes, out, "agg JOIN latest ON agg.SK_ID_CURR = latest.k", None)


_LEGACY = _spec("""
DAYS_CREDIT: min max mean
DAYS_CREDIT_ENDDATE: min max
AMT_CREDIT_MAX_OVERDUE: max mean
AMT_CREDIT_SUM: max mean sum
AMT_CREDIT_SUM_DEBT: max mean sum
AMT_CREDIT_SUM_OVERDUE: max mean sum
AMT_ANNUITY: mean sum
CNT_CREDIT_PROLONG: sum
BUREAU_DEBT_CREDIT_RATIO: mean max
BUREAU_OVERDUE_DEBT_RATIO: mean max
""")


def legacy_sql() -> str:
    months = [f"bureau_balance_MONTHS_BALANCE_{s}" for s in ("min", "max", "size")]
    shares = [f"bureau_balance_STATUS_{v}_{k}" for v in STATUSES for k in ("count", "ratio")]
    balance = ["min(MONTHS_BALANCE) AS " + months[0], "max(MONTHS_BALANCE) AS " + months[1], "count(*) AS " + months[2]]
    for v in STATUSES:
        n = f"count(*) FILTER (WHERE STATUS = '{v}')"
        balance += [f"{n} AS bureau_balance_STATUS_{v}_count", f"CAST({n} AS DOUBLE) / count(*) AS bureau_balance_STATUS_{v}_ratio"]
    spec = _LEGACY + [(c, s) for c in months + shares for s in ("mean", "sum", "min", "max")]
    aggs = [("BUREAU_LOAN_COUNT", "count(SK_ID_BUREAU)"), ("BUREAU_LOAN_TYPES", "count(DISTINCT CREDIT_TYPE)")]
    for kind, cond in (("", None), ("ACTIVE_", _ACTIVE), ("CLOSED_", _CLOSED)):
        aggs += [(f"BUREAU_{kind}{c}_{s.upper()}", _stat(c, s, cond)) for c, s in spec]
    for c, values in (("CREDIT_ACTIVE", _ACTIVE_VALUES), ("CREDIT_CURRENCY", _CURRENCIES), ("CREDIT_TYPE", _PRIORITIES)):
        for v in values:
            aggs += [(f"BUREAU_{c}_{v}_{s.upper()}", f"{'avg' if s == 'mean' else 'sum'}({_dummy(c, v)})") for s in ("mean", "sum")]
    ctes = {"b": _BALANCE, "bb": f"SELECT SK_ID_BUREAU AS k, {', '.join(balance)} FROM b GROUP BY SK_ID_BUREAU", "x": _BUREAU,
            "y": "SELECT x.*, bb.*, AMT_CREDIT_SUM_DEBT / (AMT_CREDIT_SUM + 1e-8) AS BUREAU_DEBT_CREDIT_RATIO, "
                 "AMT_CREDIT_SUM_OVERDUE / (AMT_CREDIT_SUM_DEBT + 1e-8) AS BUREAU_OVERDUE_DEBT_RATIO "
                 "FROM x LEFT JOIN bb ON x.SK_ID_BUREAU = bb.k",
            "agg": "SELECT SK_ID_CURR, " + ",\n".join(f'{e} AS "{n}"' for n, e in aggs) + " FROM y GROUP BY SK_ID_CURR"}
    out = [("SK_ID_CURR", "=customer.c_custkey")] + [(n, f'coalesce("{n}", 0)') for n, _ in aggs]
    out.append(("BUREAU_AVERAGE_LOAN_TYPE", 'coalesce("BUREAU_LOAN_COUNT", 0) / (coalesce("BUREAU_LOAN_TYPES", 0) + 1e-8)'))
    return _query(ctes, out, "customer LEFT JOIN agg ON customer.c_custkey = agg.SK_ID_CURR", None)


# -- application --------------------------------------------------------------
def _unless(cond: str, x: str) -> str:
    return f"CASE WHEN {cond} THEN NULL ELSE {x} END"


_K, _CREDIT = "c_custkey", "(abs(c_acctbal) * 40 + 50000)"
# column: SQL over customer and nation, sentinels already empty
_APPLICATION = {
    "TARGET": _unless(f"{_K} % 4 = 3", "CASE WHEN c_acctbal < 2500 THEN 1 ELSE 0 END"),
    "NAME_CONTRACT_TYPE": f"CASE WHEN {_K} % 3 = 0 THEN 'Revolving loans' ELSE 'Cash loans' END",
    "CODE_GENDER": "CASE WHEN c_nationkey % 2 = 0 THEN 'F' ELSE 'M' END",
    "FLAG_OWN_CAR": f"CASE WHEN {_K} % 2 = 0 THEN 'Y' ELSE 'N' END",
    "FLAG_OWN_REALTY": f"CASE WHEN {_K} % 5 < 3 THEN 'Y' ELSE 'N' END",
    "NAME_TYPE_SUITE": _unless(f"{_K} % 7 = 0", f"'suite_' || CAST({_K} % 3 AS VARCHAR)"),
    "NAME_INCOME_TYPE": _unless(f"{_K} % 50 = 1", f"'income_' || CAST({_K} % 4 AS VARCHAR)"),
    "NAME_EDUCATION_TYPE": "c_mktsegment",
    "NAME_FAMILY_STATUS": _unless(f"{_K} % 40 = 2", f"'family_' || CAST({_K} % 3 AS VARCHAR)"),
    "NAME_HOUSING_TYPE": f"'housing_' || CAST({_K} % 2 AS VARCHAR)",
    "OCCUPATION_TYPE": _unless(f"{_K} % 9 = 0", "n_name"),
    "WEEKDAY_APPR_PROCESS_START": f"'DAY_' || CAST({_K} % 7 AS VARCHAR)",
    "ORGANIZATION_TYPE": "'ORG_' || CAST(n_regionkey AS VARCHAR)",
    "FONDKAPREMONT_MODE": _unless(f"{_K} % 6 = 0", "'reg oper account'"),
    "WALLSMATERIAL_MODE": f"'wall_' || CAST({_K} % 3 AS VARCHAR)",
    "CNT_CHILDREN": f"{_K} % 4", "AMT_INCOME_TOTAL": "abs(c_acctbal) * 10 + 25000", "AMT_CREDIT": _CREDIT,
    "AMT_ANNUITY": _unless(f"{_K} % 13 = 0", f"{_CREDIT} / 20"),
    "AMT_GOODS_PRICE": _unless(f"{_K} % 11 = 0", f"{_CREDIT} * (CAST(0.8 AS DOUBLE) + ({_K} % 5) * CAST(0.05 AS DOUBLE))"),
    "REGION_POPULATION_RELATIVE": f"({_K} % 100) / 1000.0", "DAYS_BIRTH": f"-(7000 + ({_K} * 37) % 18000)",
    "DAYS_EMPLOYED": _unless(f"{_K} % 10 = 0", f"-(({_K} * 13) % 9000)"), "DAYS_REGISTRATION": f"-(({_K} * 7) % 12000)",
    "DAYS_ID_PUBLISH": f"-(({_K} * 17) % 6000)", "OWN_CAR_AGE": _unless(f"{_K} % 8 = 0", f"CAST({_K} % 20 AS DOUBLE)"),
    "CNT_FAM_MEMBERS": f"CAST(({_K} % 4) + 1 + c_nationkey % 2 AS DOUBLE)", "REGION_RATING_CLIENT": "n_regionkey % 3 + 1",
    "REGION_RATING_CLIENT_W_CITY": _unless(f"{_K} % 30 = 5", "n_regionkey % 3 + 1"),
    "REG_CITY_NOT_WORK_CITY": "CASE WHEN c_nationkey % 3 = 0 THEN 1 ELSE 0 END",
    "EXT_SOURCE_1": _unless(f"{_K} % 5 = 0", f"(({_K} * 31) % 1000) / 1000.0"),
    "EXT_SOURCE_2": _unless(f"{_K} % 17 = 0", f"(({_K} * 53) % 1000) / 1000.0"),
    "EXT_SOURCE_3": _unless(f"{_K} % 7 = 1", f"(({_K} * 71) % 1000) / 1000.0"),
    **{f"{c}_AVG": f"({_K} % {m}) / {d}" for c, m, d in (
        ("APARTMENTS", 97, "100.0"), ("BASEMENTAREA", 89, "100.0"), ("YEARS_BUILD", 83, "100.0"), ("ELEVATORS", 5, "10.0"),
        ("FLOORSMAX", 7, "10.0"), ("LANDAREA", 9, "10.0"), ("LIVINGAPARTMENTS", 11, "10.0"), ("LIVINGAREA", 13, "10.0"),
        ("NONLIVINGAREA", 3, "10.0"))},
    "OBS_30_CNT_SOCIAL_CIRCLE": f"CAST({_K} % 6 AS DOUBLE)", "DEF_30_CNT_SOCIAL_CIRCLE": f"CAST({_K} % 2 AS DOUBLE)",
    "OBS_60_CNT_SOCIAL_CIRCLE": f"CAST({_K} % 5 AS DOUBLE)",
    "DEF_60_CNT_SOCIAL_CIRCLE": f"CASE WHEN {_K} % 3 = 0 THEN 1.0 ELSE 0.0 END",
    "DAYS_LAST_PHONE_CHANGE": _unless(f"{_K} % 15 = 0 OR ({_K} * 3) % 3000 = 0", f"-CAST(({_K} * 3) % 3000 AS DOUBLE)"),
    "FLAG_DOCUMENT_2": f"{_K} % 2", "FLAG_DOCUMENT_3": f"({_K} + 1) % 2",
    **{f"AMT_REQ_CREDIT_BUREAU_{c}": _unless(f"{_K} % 12 = 0", f"CAST({_K} % {m} AS DOUBLE)") for c, m in (
        ("HOUR", 2), ("DAY", 3), ("WEEK", 2), ("MON", 4), ("QRT", 5), ("YEAR", 6))},
}
# every value of the encoded columns that the crosswalk makes


def _numbered(prefix: str, n: int) -> list[str]:
    return sorted(f"{prefix}{k}" for k in range(n))


def _numbers(n: int, first: int = 0) -> list[float]:
    return [float(k) for k in range(first, first + n)]


CATEGORIES = {
    "NAME_CONTRACT_TYPE": ["Cash loans", "Revolving loans"], "CODE_GENDER": ["F", "M"], "FLAG_OWN_CAR": ["N", "Y"],
    "FLAG_OWN_REALTY": ["N", "Y"], "NAME_INCOME_TYPE": _numbered("income_", 4),
    "NAME_EDUCATION_TYPE": ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"],
    "NAME_FAMILY_STATUS": _numbered("family_", 3), "NAME_HOUSING_TYPE": _numbered("housing_", 2),
    "REGION_RATING_CLIENT": [1, 2, 3], "REGION_RATING_CLIENT_W_CITY": [1, 2, 3],
    "WEEKDAY_APPR_PROCESS_START": _numbered("DAY_", 7), "ORGANIZATION_TYPE": _numbered("ORG_", 5),
    "NAME_TYPE_SUITE": _numbered("suite_", 3), "OCCUPATION_TYPE": _numbered("NATION_", 25),
    "WALLSMATERIAL_MODE": _numbered("wall_", 3), "FONDKAPREMONT_MODE": ["reg oper account"],
    "OBS_30_CNT_SOCIAL_CIRCLE": _numbers(6), "DEF_30_CNT_SOCIAL_CIRCLE": _numbers(2),
    "OBS_60_CNT_SOCIAL_CIRCLE": _numbers(5), "DEF_60_CNT_SOCIAL_CIRCLE": _numbers(2),
    "AMT_REQ_CREDIT_BUREAU_DAY": _numbers(3), "AMT_REQ_CREDIT_BUREAU_HOUR": _numbers(2),
    "AMT_REQ_CREDIT_BUREAU_WEEK": _numbers(2), "AMT_REQ_CREDIT_BUREAU_MON": _numbers(4),
    "AMT_REQ_CREDIT_BUREAU_QRT": _numbers(5), "AMT_REQ_CREDIT_BUREAU_YEAR": _numbers(6), "CNT_CHILDREN": [0, 1, 2, 3],
    "CNT_FAM_MEMBERS": _numbers(5, 1), "OWN_CAR_AGE": _numbers(20),
}
_KEPT = ["CNT_CHILDREN", "CNT_FAM_MEMBERS", "OWN_CAR_AGE", "OBS_30_CNT_SOCIAL_CIRCLE", "DEF_30_CNT_SOCIAL_CIRCLE",
         "OBS_60_CNT_SOCIAL_CIRCLE", "DEF_60_CNT_SOCIAL_CIRCLE"] + [c for c in _APPLICATION if c.startswith("AMT_REQ_")]
_GROUPS = [
    ("CODE_GENDER NAME_EDUCATION_TYPE", "AMT_ANNUITY: max\nAMT_CREDIT: max\nEXT_SOURCE_1: mean\nEXT_SOURCE_2: mean\nOWN_CAR_AGE: max sum"),
    ("CODE_GENDER ORGANIZATION_TYPE", "AMT_ANNUITY: mean\nAMT_INCOME_TOTAL: mean\nDAYS_REGISTRATION: mean\nEXT_SOURCE_1: mean"),
    ("CODE_GENDER REG_CITY_NOT_WORK_CITY", "AMT_ANNUITY: mean\nCNT_CHILDREN: mean\nDAYS_ID_PUBLISH: mean"),
    ("CODE_GENDER NAME_EDUCATION_TYPE OCCUPATION_TYPE REG_CITY_NOT_WORK_CITY", "EXT_SOURCE_1: mean\nEXT_SOURCE_2: mean"),
    ("NAME_EDUCATION_TYPE OCCUPATION_TYPE", "\n".join(f"{c}: mean" for c in (
        "AMT_CREDIT AMT_REQ_CREDIT_BUREAU_YEAR APARTMENTS_AVG BASEMENTAREA_AVG EXT_SOURCE_1 EXT_SOURCE_2 EXT_SOURCE_3 "
        "NONLIVINGAREA_AVG OWN_CAR_AGE YEARS_BUILD_AVG").split())),
    ("NAME_EDUCATION_TYPE OCCUPATION_TYPE REG_CITY_NOT_WORK_CITY", "ELEVATORS_AVG: mean\nEXT_SOURCE_1: mean"),
    ("OCCUPATION_TYPE", "\n".join(f"{c}: mean" for c in (
        "AMT_ANNUITY CNT_CHILDREN CNT_FAM_MEMBERS DAYS_BIRTH DAYS_EMPLOYED DAYS_ID_PUBLISH DAYS_REGISTRATION EXT_SOURCE_1 "
        "EXT_SOURCE_2 EXT_SOURCE_3").split())),
]
_AGE, _JOB, _EXT = "AGE_YEARS", "YEARS_EMPLOYED", ["EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3"]
_MONEY = {"CREDIT": "AMT_CREDIT", "INCOME": "AMT_INCOME_TOTAL", "ANNUITY": "AMT_ANNUITY", "GOODS": "AMT_GOODS_PRICE"}


def _one_more(a: str, b: str) -> str:
    return _over(a, f"(1.0 + {b})")


def _application_ratios() -> list[tuple[str, str]]:
    credit, income, annuity, goods = _MONEY.values()
    out = [(f"RATIO_{credit}_TO_{goods}", _over(credit, goods)), (f"RATIO_{credit}_TO_{income}", _one_more(credit, income)),
           (f"RATIO_{credit}_TO_{annuity}", _over(credit, annuity)),
           (f"RATIO_{credit}_TO_EXT_SOURCE_MEAN", _one_more(credit, "EXT_SOURCE_MEAN")),
           (f"RATIO_{annuity}_{credit}", _over(annuity, credit)), (f"RATIO_{annuity}_TO_{goods}", _over(annuity, goods)),
           (f"RATIO_{annuity}_TO_{income}", _one_more(annuity, income)), (f"RATIO_{income}_TO_{credit}", _one_more(income, credit)),
           (f"RATIO_{income}_TO_{annuity}", _over(income, annuity)), (f"RATIO_{income}_TO_{goods}", _over(income, goods)),
           (f"RATIO_{income}_TO_AGE_YEARS", _one_more(income, _AGE)), (f"RATIO_{income}_TO_EMPLOYED_YEARS", _one_more(income, _JOB)),
           ("RATIO_CNT_CHILDREN_TO_CNT_FAM_MEMBERS", _over("CNT_CHILDREN", "CNT_FAM_MEMBERS"))]
    for name, years in (("AGE_YEARS", _AGE), ("EMPLOYED_YEARS", _JOB)):
        out += [(f"RATIO_{c}_TO_{name}", _one_more(c, years)) for c in [*_EXT, "EXT_SOURCE_MEAN"]]
    return out + [(f"RATIO_{goods}_TO_{n}", _over(goods, c)) for n, c in (
        ("LIVINGAREA_AVG", "LIVINGAREA_AVG"), ("LANDAREA_AVG", "LANDAREA_AVG"), ("FLOORSMAX_AVG_AVG", "FLOORSMAX_AVG"),
        ("LIVINGAPARTMENTS_AVG", "LIVINGAPARTMENTS_AVG"))]


def _application_row() -> list[tuple[str, str]]:
    """Columns that follow from one row."""
    def flag(cond):
        return f"CASE WHEN {cond} THEN 1 ELSE 0 END"

    def total(cols):
        return " + ".join(f"coalesce({c}, 0)" for c in cols)

    ext = f"[{', '.join(f'CAST({c} AS DOUBLE)' for c in _EXT)}]"
    out = [("FLAG_DOCUMENTS_TOTAL", "FLAG_DOCUMENT_2 + FLAG_DOCUMENT_3"),
           ("FLAG_DOCUMENTS_PROVIDED_RATIO", "(FLAG_DOCUMENT_2 + FLAG_DOCUMENT_3) / 2.0"),
           ("FLAG_AGE_GT_EMPLOYED", flag(f"{_AGE} > {_JOB}")),
           ("FLAG_DAYS_LAST_PHONE_CHANGE_NEGATIVE", flag("DAYS_LAST_PHONE_CHANGE < 0")),
           ("INTERACTION_AGE_EMPLOYED", f"{_AGE} * {_JOB}"), ("YEARS_EMPLOYED_PERCENT", _over(_JOB, _AGE))]
    out += [(f"INTERACTION_AMT_{a}_{b}", f"{_MONEY[a]} * {_MONEY[b]}") for a, b in (
        ("INCOME", "CREDIT"), ("INCOME", "ANNUITY"), ("INCOME", "GOODS"), ("CREDIT", "ANNUITY"), ("CREDIT", "GOODS"), ("ANNUITY", "GOODS"))]
    out += [(f"INTERACTION_{c}_{n}", f"{c} * {y}") for n, y in (("AGE", _AGE), ("EMPLOYED", _JOB)) for c in [*_EXT, "EXT_SOURCE_MEAN"]]
    out += [("HAS_CHILDREN", flag("CNT_CHILDREN > 0")), ("HAS_JOB", flag("DAYS_EMPLOYED < 0")),
            ("LONG_EMPLOYMENT", flag("DAYS_EMPLOYED < -2000")), ("RETIREMENT_AGE", flag("DAYS_BIRTH < -14000")),
            ("SUM_AMT_INCOME_TOTAL_AMT_ANNUITY", "AMT_INCOME_TOTAL + AMT_ANNUITY"),
            ("TOTAL_ENQUIRIES_CREDIT_BUREAU", total(c for c in _APPLICATION if c.startswith("AMT_REQ_"))),
            ("EXT_SOURCES_SUM", total(_EXT)), ("EXT_SOURCES_WEIGHTED_SUM", "EXT_SOURCE_3 * 5 + EXT_SOURCE_1 * 3 + EXT_SOURCE_2"),
            ("EXT_SOURCES_WEIGHTED_AVG", "(EXT_SOURCE_3 * 5 + EXT_SOURCE_1 * 3 + EXT_SOURCE_2) / 3")]
    out += [(f"EXT_SOURCES_{n}", f"list_aggregate({ext}, '{f}')") for n, f in (
        ("MEAN", "avg"), ("MAX", "max"), ("MIN", "min"), ("MEDIAN", "median"), ("STD", "stddev_samp"))]
    return out + [(n, f"{a} - {b}") for n, a, b in (
        ("DIFF_AMT_CREDIT_AMT_GOODS_PRICE", "AMT_CREDIT", "AMT_GOODS_PRICE"),
        ("DIFF_AMT_ANNUITY_AMT_GOODS_PRICE", "AMT_ANNUITY", "AMT_GOODS_PRICE"),
        ("DIFF_AMT_INCOME_TOTAL_AMT_ANNUITY", "AMT_INCOME_TOTAL", "AMT_ANNUITY"),
        ("CNT_ADULT_FAM_MEMBER", "CNT_FAM_MEMBERS", "CNT_CHILDREN"),
        ("DIFF_OBS_30_CNT_SOCIAL_CIRCLE_OBS_60_CNT_SOCIAL_CIRCLE", "OBS_30_CNT_SOCIAL_CIRCLE", "OBS_60_CNT_SOCIAL_CIRCLE"),
        ("DIFF_DEF_30_CNT_SOCIAL_CIRCLE_DEF_60_CNT_SOCIAL_CIRCLE", "DEF_30_CNT_SOCIAL_CIRCLE", "DEF_60_CNT_SOCIAL_CIRCLE"))]


def application_sql(labelled: bool = False) -> str:
    """The application features; with ``labelled`` groups, moments and medians are those of labelled rows."""
    fit_rows = "TARGET IS NOT NULL" if labelled else "true"
    groups, joins, grouped = {}, "", []
    for k, (keys, spec) in enumerate(_GROUPS):
        keys, spec = keys.split(), _spec(spec)
        known = " AND ".join(f"{c} IS NOT NULL" for c in keys)
        aggs = ", ".join(f"{_stat(c, s)} AS {c}_{s}" for c, s in spec)
        groups[f"g{k}"] = f"SELECT {', '.join(keys)}, {aggs} FROM y WHERE {known} AND {fit_rows} GROUP BY {', '.join(keys)}"
        joins += f" LEFT JOIN g{k} ON " + " AND ".join(f"z.{c} = g{k}.{c}" for c in keys)
        for c, s in spec:
            name, value = "_".join([*keys, s.upper(), c]), f"g{k}.{c}_{s}"
            grouped.append((name, value))
            if s != "sum":
                grouped += [(f"{name}_DIFF", f"z.{c} - {value}"), (f"{name}_ABS_DIFF", f"abs(z.{c} - {value})")]
    scaled = [*_EXT, "AMT_INCOME_TOTAL", "AMT_CREDIT", "AMT_ANNUITY", "AMT_GOODS_PRICE", "DAYS_EMPLOYED", "DAYS_BIRTH",
              "DAYS_REGISTRATION", "DAYS_ID_PUBLISH", "DAYS_LAST_PHONE_CHANGE"]
    scaled += ["RATIO_" + c for c in (
        "AMT_CREDIT_TO_AMT_INCOME_TOTAL AMT_ANNUITY_TO_AMT_INCOME_TOTAL AMT_CREDIT_TO_AMT_ANNUITY AMT_CREDIT_TO_AMT_GOODS_PRICE "
        "AMT_INCOME_TOTAL_TO_AMT_CREDIT AMT_INCOME_TOTAL_TO_AMT_ANNUITY EXT_SOURCE_MEAN_TO_AGE_YEARS "
        "EXT_SOURCE_MEAN_TO_EMPLOYED_YEARS").split()]
    poly = [*_EXT, "EXT_SOURCE_MEAN", _AGE, _JOB, "AMT_CREDIT", "AMT_ANNUITY", "AMT_INCOME_TOTAL", "AMT_GOODS_PRICE",
            "DAYS_BIRTH", "DAYS_EMPLOYED", "DAYS_ID_PUBLISH", "DAYS_REGISTRATION"]
    fits = [f"avg({c}) AS mu_{c}, stddev_samp({c}) AS sd_{c}" for c in scaled] + [f"median({c}) AS md_{c}" for c in poly]
    base = ", ".join(f"{e} AS {c}" for c, e in _APPLICATION.items())
    own = [c for c in _APPLICATION if c not in CATEGORIES or c in _KEPT] + ["EXT_SOURCE_MEAN", _AGE, _JOB]
    row = _application_ratios() + _application_row()
    ctes = {"x": f"SELECT c_custkey AS SK_ID_CURR, {base} FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey",
            "y": "SELECT *, (" + " + ".join(f"coalesce({c}, 0)" for c in _EXT) + ") / 3.0 AS EXT_SOURCE_MEAN, "
                 f"DAYS_BIRTH / -365.25 AS {_AGE}, DAYS_EMPLOYED / -365.25 AS {_JOB} FROM x",
            **groups, "z": "SELECT *, " + ",\n".join(f"{e} AS {n}" for n, e in row) + " FROM y",
            "s": f"SELECT {', '.join(fits)} FROM z WHERE {fit_rows}"}
    out = [("SK_ID_CURR", "=z.SK_ID_CURR")] + [(c, f"z.{c}") for c in own] + grouped + [(n, f"z.{n}") for n, _ in row]
    out += [(f"Z_{c}", f"CASE WHEN sd_{c} > 0 THEN (z.{c} - mu_{c}) / sd_{c} END") for c in scaled]
    filled = {c: f"CAST(coalesce(z.{c}, md_{c}) AS DOUBLE)" for c in poly}
    out += [(f"POLY_{c}", filled[c]) for c in poly]
    out += [(f"POLY_{a}^2" if a == b else f"POLY_{a} {b}", f"{filled[a]} * {filled[b]}")
            for k, a in enumerate(poly) for b in poly[k:]]
    for c, values in CATEGORIES.items():
        out += [(f"{c}_CAT_{v}", f"CASE WHEN z.{c} = {repr(v)} THEN 1 ELSE 0 END") for v in values]
    return _query(ctes, out, f"z{joins} CROSS JOIN s", None)


def build_sql() -> str:
    """The full build: the application frame and the five child frames, with sanitised names."""
    parts = {"a": application_sql(), "b": bureau_sql(), "p": previous_sql(), "s": pos_sql(), "i": installments_sql(),
             "c": card_sql()}
    out = ["a.SK_ID_CURR AS SK_ID_CURR"]
    for alias, sql in parts.items():
        for name in re.findall(r'"([^"]+)"(?=,\n  |\sFROM wide)', sql[sql.rindex("\nSELECT "):]):
            if name == "SK_ID_CURR":
                continue
            # the build empties the infinities that the previous applications' ratios make
            value = f'{alias}."{name}"'
            value = f"CASE WHEN abs({value}) < {_FAR} THEN {value} END" if name.startswith("PREV_RATIO_") else value
            out.append(f'{value} AS "{sanitize_name(name)}"')
    joins = "".join(f"\nLEFT JOIN ({sql}) {alias} ON a.SK_ID_CURR = {alias}.SK_ID_CURR"
                    for alias, sql in parts.items() if alias != "a")
    return "SELECT " + ",\n".join(out) + f"\nFROM ({parts['a']}) a{joins}"


def correlation_sql() -> str:
    """Correlations of all pairs of columns of the application features."""
    return f"""
WITH f AS ({application_sql()}),
place AS (SELECT column_name AS c, row_number() OVER (ORDER BY column_name) AS p FROM (DESCRIBE f) WHERE column_name <> 'SK_ID_CURR'),
long AS (SELECT k, p, c, v FROM (
    SELECT SK_ID_CURR AS k, c, v FROM (SELECT * FROM f) UNPIVOT (v FOR c IN (* EXCLUDE (SK_ID_CURR)))) JOIN place USING (c)),
held AS (SELECT a.p AS pa, b.p AS pb, count(*) AS n, min(a.v) < max(a.v) AND min(b.v) < max(b.v) AS varies, corr(a.v, b.v) AS r
         FROM long a JOIN long b ON a.k = b.k AND a.p < b.p GROUP BY a.p, b.p)
SELECT x.c AS FEATURE_A, y.c AS FEATURE_B, CAST(coalesce(n, 0) AS BIGINT) AS N, CASE WHEN varies THEN round(r, 4) + 0.0 END AS CORR
FROM place x JOIN place y ON x.p < y.p LEFT JOIN held ON pa = x.p AND pb = y.p
"""


#: Wide queries whose whole output is compared.
SQL = {"s4_p10_full_feature_build": build_sql,
       "a1_a10_w1_bureau_features": bureau_sql, "a32_a35_bureau_counts_variant": legacy_sql,
       "a11_a14_e7_previous_features": previous_sql, "a15_a17_w2_pos_features": pos_sql,
       "a18_a23_w3_installment_features": installments_sql, "a24_a25_card_features": card_sql,
       "x1_x11_e2_application_features": application_sql,
       "j3_a26_e2_fitted_application_state": lambda: application_sql(labelled=True)}
