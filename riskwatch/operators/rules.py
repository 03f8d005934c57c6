"""Alert rules and decisions as columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskwatch import config as c
from riskwatch.functions.scalars import in_set, is_true, safe_divide


def qualifies(limits: c.QualifierLimits) -> Column:
    """1 when the merchant is material by exposure and score, or balance."""
    exposure = F.col("fds_exposure_current")
    weak = (exposure >= limits.exposure_with_low_score) & (
        F.col("db_failure_score_current") < limits.low_score_below
    )
    indebted = F.col("nb_balance_current") <= limits.balance_at_most
    return F.when(weak | indebted | (exposure >= limits.exposure_alone), 1).otherwise(0)


def score_drop_alert(bands: tuple) -> Column:
    """Alert when the change reaches the limit of the current score's band."""
    score, change = F.col("db_failure_score_current"), F.col("db_failure_score_change")

    def reached(band: tuple) -> Column:
        low, high, limit = band
        inside = score >= low if high is None else score.between(low, high)
        return inside & (change <= limit)

    return F.when(reduce(Column.__or__, map(reached, bands)), c.NEW_ALERT).otherwise(c.NO_ALERT)


def chargeback_alert(params: c.ChargebackParams) -> Column:
    """First match: new, risen since the last alert, due again."""
    rate, last = F.col("cb_rate_30days"), F.col("chargeback_monitoring_rate_last")
    above = rate - F.col("reference_cb_rate") >= params.above_reference
    triggered = F.col("chargeback_monitoring_trigger_last")
    old = F.col("chargeback_monitoring_days_since") >= params.retrigger_days
    return (
        F.when(above & triggered.isNull(), c.NEW_ALERT)
        .when((rate - last >= params.above_last) & triggered, c.CHARGEBACK_INCREASE)
        .when(above & triggered & old, c.CHARGEBACK_RETRIGGER)
        .otherwise(c.NO_ALERT)
    )


def negative_balance_alert(params: c.NegativeBalanceParams) -> Column:
    """First match: no earlier alert, grown by the ratio, deeper and old."""
    now, before = F.col("nb_balance_current"), F.col("nb_balance_prev")
    deeper = (now < before) & (F.col("neg_bal_monitoring_days_since") > params.retrigger_days)
    return (
        F.when(~is_true(F.col("neg_bal_monitoring_trigger_last")), c.NEW_ALERT)
        .when(safe_divide(now, before) >= params.growth_ratio, c.BALANCE_DOUBLED)
        .when(deeper, c.BALANCE_INCREASED)
        .otherwise(c.NO_ALERT)
    )


def reference_rate(min_chargebacks: int) -> Column:
    """The category's rate when it has enough chargebacks, else the portfolio's."""
    return F.when(
        F.col("mcc_chargeback_vol_last_12m") >= min_chargebacks,
        F.col("mcc_chargeback_rate_vol_last_12m"),
    ).otherwise(F.col("portfolio_chargeback_rate_vol_last_12m"))


def exceeds_sanctioned(params: c.SanctionedExposureParams) -> Column:
    """Exposure material and above the sanctioned amount by the factor."""
    exposure, sanctioned = F.col("fds_exposure_current"), F.col("Sanctioned_Credit_Risk_Exposure")
    rule = (
        (sanctioned > 0)
        & (exposure >= params.min_exposure)
        & (exposure > sanctioned * params.exceeds_by)
    )
    return rule & ~F.col("insolvency_flag") if params.exclude_insolvent else rule


def managed_label(flag: Column, stage: Column) -> Column:
    """'Yes' when flagged as managed or in a managed stage."""
    return F.when(is_true(flag) | in_set(stage, c.MANAGED_STAGES), "Yes").otherwise("No")


def onboarding_decisions(params: c.OnboardingParams) -> dict[str, Column]:
    """Industry flags, the freeze decision and the ticket decision."""
    code, paid = F.col("merchant_category_code"), F.col("payment_gbp_amount_in_all_time")
    restricted = in_set(code, params.restricted_codes)
    compliance = in_set(code, params.compliance_codes)
    inactive = F.col("salesforce_opportunity_id").isNull() & (paid.isNull() | (paid == 0))
    return {
        "restricted_industry": restricted,
        "compliance_hrob": compliance,
        "freeze_account_action": F.when(restricted | (compliance & inactive), True).otherwise(False),
        "create_zendesk_ticket": compliance,
    }


def stub_actions() -> dict[str, Column]:
    """Account actions that are declared but never asked for."""
    never, unset = F.lit(False), F.lit(None).cast("bigint")
    return {
        c.FREEZE_ACCOUNT: never,
        c.DISABLE_PAYOUTS: never,
        c.CHANGE_HOLDING_PERIOD: unset,
        c.APPLY_BALANCE_LIMITS: unset,
    }
