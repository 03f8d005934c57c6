"""Rules at their limits."""

import pytest

from riskwatch import config as c
from riskwatch.operators import rules
from riskwatch.functions.scalars import MONEY

QUALIFIER = "fds_exposure_current {m}, db_failure_score_current bigint, nb_balance_current {m}".format(m=MONEY)


def evaluate(spark, ddl, row, column):
    text = [None if v is None else str(v) for v in row]
    names = [part.strip().split(" ")[0] for part in ddl.split(", ")]
    frame = spark.createDataFrame([tuple(text)], ", ".join(f"{n} string" for n in names))
    typed = frame.selectExpr(*[f"cast({n} as {p.strip().split(' ', 1)[1]}) as {n}" for n, p in zip(names, ddl.split(", "))])
    return typed.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "row, expected",
    [
        (("250000", 39, "0"), 1),
        (("249999.99", 39, "0"), 0),
        (("250000", 40, "0"), 0),
        (("250000", None, "0"), 0),
        (("500000", None, "0"), 1),
        (("499999.99", 99, "0"), 0),
        ((None, None, "-20000"), 1),
        ((None, None, "-19999.99"), 0),
        ((None, None, None), 0),
    ],
)
def test_qualifier(spark, row, expected):
    assert evaluate(spark, QUALIFIER, row, rules.qualifies(c.QualifierLimits())) == expected


@pytest.mark.parametrize(
    "score, limit",
    [(100, -30), (86, -30), (85, -20), (51, -20), (50, -10), (30, -10), (29, -5), (11, -5), (10, -2), (1, -2)],
)
def test_score_bands(spark, score, limit):
    ddl = "db_failure_score_current bigint, db_failure_score_change bigint"
    alert = rules.score_drop_alert(c.SCORE_DROP_BANDS)
    found = [evaluate(spark, ddl, (score, limit + d), alert) for d in (-1, 0, 1)]
    assert found == [c.NEW_ALERT, c.NEW_ALERT, c.NO_ALERT]


@pytest.mark.parametrize("row", [(0, -90), (None, -90), (50, None)])
def test_no_score_no_alert(spark, row):
    ddl = "db_failure_score_current bigint, db_failure_score_change bigint"
    assert evaluate(spark, ddl, row, rules.score_drop_alert(c.SCORE_DROP_BANDS)) == c.NO_ALERT


CHARGEBACK = (
    "cb_rate_30days double, reference_cb_rate double, chargeback_monitoring_rate_last double, "
    "chargeback_monitoring_trigger_last boolean, chargeback_monitoring_days_since int"
)


@pytest.mark.parametrize(
    "row, expected",
    [
        ((0.25, 0.125, None, None, None), c.NEW_ALERT),
        ((0.04, 0.0, None, None, None), c.NEW_ALERT),
        ((0.0399, 0.0, None, None, None), c.NO_ALERT),
        ((None, 0.0, None, None, None), c.NO_ALERT),
        ((0.25, None, None, None, None), c.NO_ALERT),
        # The increase is in percentage points and needs no distance to the reference.
        ((0.1, 0.5, 0.0, True, 1), c.CHARGEBACK_INCREASE),
        ((0.0999, 0.5, 0.0, True, 1), c.NO_ALERT),
        ((0.25, 0.0, 0.25, True, 90), c.CHARGEBACK_RETRIGGER),
        ((0.25, 0.0, 0.25, True, 89), c.NO_ALERT),
        ((0.25, 0.0, None, True, 90), c.CHARGEBACK_RETRIGGER),
    ],
)
def test_chargeback_alert(spark, row, expected):
    assert evaluate(spark, CHARGEBACK, row, rules.chargeback_alert(c.ChargebackParams())) == expected


BALANCE = (
    "nb_balance_current decimal(20;2), nb_balance_prev double, neg_bal_monitoring_trigger_last boolean, "
    "neg_bal_monitoring_days_since int"
).replace(";", ",")


@pytest.mark.parametrize(
    "now, before, trigger, age, expected",
    [
        ("-100", None, None, None, c.NEW_ALERT),
        ("-100", "-90", False, 1, c.NEW_ALERT),
        ("-200", "-100", True, 1, c.BALANCE_DOUBLED),
        ("-199.99", "-100", True, 90, c.NO_ALERT),
        ("-199.99", "-100", True, 91, c.BALANCE_INCREASED),
        ("-100", "0", True, 1, c.NO_ALERT),
        ("-100", "0", True, 91, c.BALANCE_INCREASED),
        ("0", "-100", True, 91, c.NO_ALERT),
        ("-100", None, True, 91, c.NO_ALERT),
    ],
)
def test_negative_balance_alert(spark, now, before, trigger, age, expected):
    frame = spark.createDataFrame(
        [(now, before, trigger, age)], "now string, before string, t boolean, age int"
    ).selectExpr(
        "cast(now as decimal(20,2)) as nb_balance_current", "cast(before as double) as nb_balance_prev",
        "t as neg_bal_monitoring_trigger_last", "age as neg_bal_monitoring_days_since",
    )
    alert = rules.negative_balance_alert(c.NegativeBalanceParams())
    assert frame.select(alert.alias("x")).first()["x"] == expected


@pytest.mark.parametrize("chargebacks, expected", [(999, 0.5), (1000, 0.25), (None, 0.5)])
def test_reference_rate_falls_back_to_the_portfolio(spark, chargebacks, expected):
    ddl = ("mcc_chargeback_vol_last_12m bigint, mcc_chargeback_rate_vol_last_12m double, "
           "portfolio_chargeback_rate_vol_last_12m double")
    assert evaluate(spark, ddl, (chargebacks, 0.25, 0.5), rules.reference_rate(1000)) == expected


@pytest.mark.parametrize(
    "exposure, sanctioned, insolvent, expected",
    [
        ("240000.1", "200000", False, True),
        ("240000.0", "200000", False, False),
        ("199999.9", "1", False, False),
        ("200000.0", "1", False, True),
        ("240000.1", "200000", True, False),
        ("240000.1", "0", False, False),
        ("240000.1", None, False, None),
    ],
)
def test_sanctioned_limit(spark, exposure, sanctioned, insolvent, expected):
    ddl = f"fds_exposure_current double, Sanctioned_Credit_Risk_Exposure double, insolvency_flag boolean"
    rule = rules.exceeds_sanctioned(c.SanctionedExposureParams())
    assert evaluate(spark, ddl, (exposure, sanctioned, insolvent), rule) == expected


@pytest.mark.parametrize(
    "code, opportunity, paid, expected",
    [
        (4511, "P", 9.0, (True, False, True, False)),
        (8249, None, None, (False, True, True, True)),
        (8249, None, 0.0, (False, True, True, True)),
        (8249, None, 0.01, (False, True, False, True)),
        (8249, "P", None, (False, True, False, True)),
        (7995, "P", 5.0, (True, True, True, True)),
        (1, None, None, (False, False, False, False)),
        (None, None, None, (False, False, False, False)),
    ],
)
def test_onboarding(spark, code, opportunity, paid, expected):
    frame = spark.createDataFrame(
        [(code, opportunity, paid)],
        "merchant_category_code bigint, salesforce_opportunity_id string, payment_gbp_amount_in_all_time double",
    )
    decisions = rules.onboarding_decisions(c.OnboardingParams())
    assert tuple(frame.select(*[v.alias(k) for k, v in decisions.items()]).first()) == expected
