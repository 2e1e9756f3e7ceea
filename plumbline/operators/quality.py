"""Earnings-quality score: the published 1999 eight-variable manipulation model."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline import names
from plumbline.functions.expressions import col, day_of, total_of
from plumbline.operators.dedup import first_per_key

# --- fixed values: coefficients of the published model -------------------------------------------
M_INTERCEPT = -4.84
M_WEIGHTS = {
    "dsri": 0.920, "gmi": 0.528, "aqi": 0.404, "sgi": 0.892,
    "depi": 0.115, "sgai": -0.172, "tata": 4.679, "lvgi": -0.327,
}
ACCOUNT_COLUMNS = [
    "receivables", "sales", "cogs", "current_assets", "ppe", "securities", "total_assets",
    "depreciation", "sga", "income", "cash_from_ops", "current_liabilities", "long_term_debt",
]
# --- end of fixed values -------------------------------------------------------------------------

# Half a month: a period end up to that long after a quarter's last day still belongs to it.
SHIFT_DAYS = 15


def m_score(
    accounts: DataFrame, entity: str = names.ENTITY, period: str = names.PERIOD,
    cutoff: float = names.MANIPULATOR_CUTOFF, unique: bool = False,
) -> DataFrame:
    """Key, eight ratios, `m_score` and `likely_manipulator`, one row per key.

    The year-earlier row of the same entity is found by an equi-join on entity and fiscal quarter, the
    quarter of the day SHIFT_DAYS earlier: period ends that move by days from year to year (month ends,
    52/53-week years) stay in one quarter. Of several rows in a quarter the latest is the earlier one.
    Copies of a key are dropped first (say ``unique`` if there are none), so the join neither multiplies
    rows nor gathers an entity into one task. The score is missing when any ratio is, and so where the
    period is no date.
    """
    if not unique:
        accounts = first_per_key(accounts, [entity, period])
    shifted = F.date_sub(day_of(col(period)), SHIFT_DAYS)
    quarter = F.year(shifted) * 4 + F.quarter(shifted)
    now = accounts.select(col(entity).alias("__entity"), quarter.alias("__quarter"), col(entity), col(period),
                          *[col(c).alias(f"t_{c}") for c in ACCOUNT_COLUMNS])
    known = accounts.withColumn("__quarter", quarter + 4).where(F.col("__quarter").isNotNull())
    before = first_per_key(known, [entity, "__quarter"], [day_of(col(period)).desc()]).select(
        col(entity).alias("__entity"), "__quarter",
        *[col(c).alias(f"p_{c}") for c in ACCOUNT_COLUMNS])
    both = now.join(before, ["__entity", "__quarter"], "left")

    ratio = F.try_divide

    def t(name):
        return F.col(f"t_{name}").cast("double")

    def p(name):
        return F.col(f"p_{name}").cast("double")

    def margin(at):
        return ratio(at("sales") - at("cogs"), at("sales"))

    def soft_assets(at):
        hard = at("current_assets") + at("ppe") + at("securities")
        return F.lit(1.0) - ratio(hard, at("total_assets"))

    def wear(at):
        return ratio(at("depreciation"), at("ppe") + at("depreciation"))

    def leverage(at):
        return ratio(at("current_liabilities") + at("long_term_debt"), at("total_assets"))

    ratios = {
        "dsri": ratio(ratio(t("receivables"), t("sales")), ratio(p("receivables"), p("sales"))),
        "gmi": ratio(margin(p), margin(t)),
        "aqi": ratio(soft_assets(t), soft_assets(p)),
        "sgi": ratio(t("sales"), p("sales")),
        "depi": ratio(wear(p), wear(t)),
        "sgai": ratio(ratio(t("sga"), t("sales")), ratio(p("sga"), p("sales"))),
        "tata": ratio(t("income") - t("cash_from_ops"), t("total_assets")),
        "lvgi": ratio(leverage(t), leverage(p)),
    }
    rated = both.select(col(entity), col(period), *[r.alias(n) for n, r in ratios.items()])
    score = F.lit(M_INTERCEPT) + total_of([F.lit(w) * F.col(n) for n, w in M_WEIGHTS.items()])
    return rated.withColumn("m_score", score).withColumn(
        "likely_manipulator", F.col("m_score") > F.lit(cutoff))
