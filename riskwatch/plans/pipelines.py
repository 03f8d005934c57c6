"""The processes, from sources to the emitted table."""

from __future__ import annotations

from datetime import date, timedelta
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskwatch import config as c
from riskwatch.functions.scalars import safe_divide, safe_subtract
from riskwatch.operators import rules
from riskwatch.plans import features, merge
from riskwatch.plans import payloads as p
from riskwatch.sources.result_log import emit
from riskwatch.sources.tables import Sources

DEFAULT_SETTINGS = c.TicketSettings()


def score_drop(sources: Sources, as_of: date, params=c.ScoreDropParams(), settings=DEFAULT_SETTINGS) -> DataFrame:
    """Merchants whose external failure score fell sharply yesterday."""
    alert = rules.score_drop_alert(params.bands)
    keep = F.col("db_failure_score_current_date") == F.date_sub(F.lit(as_of), 1)
    if params.only_alerts:
        keep &= alert == c.NEW_ALERT
    rows = merge.score_drop(sources, as_of, params.creditor_ids, keep, params.exclude_insolvent).withColumns({
        "merchant_monitoring_qualifyer": rules.qualifies(params.qualifier),
        "failure_score_monitoring_alert": alert,
    })
    if params.require_qualifier:
        rows = rows.where(F.col("merchant_monitoring_qualifyer") == 1)
    ticket = p.create_ticket(
        settings, p.score_drop_body(settings), p.subject("D&B Score", ""), params.category_tag
    )
    return emit(rows, c.PROCESS_SCORE_DROP, **{c.CREATE_TICKET: ticket}, **rules.stub_actions())


def chargeback(sources: Sources, as_of: date, params=c.ChargebackParams(), settings=DEFAULT_SETTINGS) -> DataFrame:
    """Merchants whose 30-day chargeback rate exceeds the reference rate."""
    alert = rules.chargeback_alert(params)
    keep = alert != c.NO_ALERT if params.only_alerts else None
    # An alert needs a rate, so categories without payments cannot show up in one.
    rows = merge.chargeback(sources, as_of, params, idle=not params.only_alerts, keep=keep).withColumns({
        "merchant_monitoring_qualifyer": rules.qualifies(params.qualifier),
        "chargeback_monitoring_alert": alert,
    })
    if params.require_qualifier:
        rows = rows.where(F.col("merchant_monitoring_qualifyer") == 1)
    ticket = p.create_ticket(
        settings, p.chargeback_body(settings), p.subject("Chargebacks", "N/A"), params.category_tag
    )
    return emit(rows, c.PROCESS_CHARGEBACK, **{c.CREATE_TICKET: ticket})


def negative_balance(
    sources: Sources, as_of: date, params=c.NegativeBalanceParams(), settings=DEFAULT_SETTINGS
) -> DataFrame:
    """Merchants with a new, doubled or deepened negative balance."""
    now, before = F.col("nb_balance_current"), F.col("nb_balance_prev")
    alert = rules.negative_balance_alert(params)
    conditions = []
    if params.max_balance is not None:
        conditions.append(now <= params.max_balance)
    if params.exclude_insolvent:
        conditions.append(~F.col("insolvency_flag"))
    if params.only_alerts:
        conditions.append(alert != c.NO_ALERT)
    keep = reduce(Column.__and__, conditions) if conditions else None
    rows = merge.negative_balance(sources, as_of, params.creditor_ids, keep).withColumns({
        "nb_alert_type": alert,
        "NB_Increase": safe_subtract(-now.cast("double"), -before),
    })
    if keep is not None:
        # A repeated creditor may be kept by one of its rows only.
        rows = rows.where(keep)
    if params.max_last_payment_days is not None:
        rows = rows.where(F.col("last_payment_days_ago") <= params.max_last_payment_days)
    ticket = p.create_ticket(
        settings, p.negative_balance_body(settings), p.subject("Negative Balance"), params.category_tag
    )
    return emit(rows, c.PROCESS_NEGATIVE_BALANCE, **{c.CREATE_TICKET: ticket})


def sanctioned_exposure(
    sources: Sources, as_of: date, params=c.SanctionedExposureParams(), settings=DEFAULT_SETTINGS
) -> DataFrame:
    """Merchants whose exposure exceeds the sanctioned amount by a factor."""
    keep = rules.exceeds_sanctioned(params)
    rows = merge.sanctioned(sources, as_of, params.group_name, params.creditor_ids, keep).withColumn(
        "FDS_Increase", safe_divide(F.col("fds_exposure_current"), F.col("Sanctioned_Credit_Risk_Exposure"))
    )
    ticket = p.create_ticket(
        settings, p.sanctioned_body(settings), p.subject(params.subject_topic), params.category_tag
    )
    return emit(rows, c.PROCESS_SANCTIONED, **{c.CREATE_TICKET: ticket})


def re_review(sources: Sources, as_of: date, params=c.ReReviewParams(), settings=DEFAULT_SETTINGS) -> DataFrame:
    """Merchants whose ticketed next review date has come up."""
    dates = params.review_dates or (as_of, as_of + timedelta(days=1))
    due = F.col("next_review_date").isin(*dates)
    rows = merge.re_review(sources, as_of, params.creditor_ids, keep=due)
    ticket = p.create_ticket(
        settings, p.re_review_body(settings), p.subject("Re-Review"), params.category_tag
    )
    return emit(rows, c.PROCESS_RE_REVIEW, **{c.CREATE_TICKET: ticket})


def insolvency(sources: Sources, as_of: date, params=c.InsolvencyParams(), settings=DEFAULT_SETTINGS) -> DataFrame:
    """Insolvent merchants with material exposure or volume."""
    material = (F.col("fds_exposure_current") >= params.min_exposure) | (
        F.col("merchant_payment_amt_gbp_last_365d") >= params.min_paid
    )
    rows = merge.insolvency(sources, as_of, params, keep=F.col("insolvency_flag")).where(material)
    if params.limit is not None:
        rows = rows.orderBy("creditor_id").limit(params.limit)
    ticket = p.create_ticket(settings, p.insolvency_body(), F.lit(params.subject), tag=None, assign=False)
    return emit(rows, c.PROCESS_INSOLVENCY, **{c.CREATE_TICKET: ticket})


def high_risk_onboarding(
    sources: Sources, as_of: date, params=c.OnboardingParams(), settings=DEFAULT_SETTINGS
) -> DataFrame:
    """New merchants in restricted or high-risk industries; plain columns."""
    return features.onboarding_amounts(sources, as_of, params).withColumns(
        rules.onboarding_decisions(params)
    )


def ticket_update(
    sources: Sources, as_of: date, params=c.TicketUpdateParams(), settings=DEFAULT_SETTINGS
) -> DataFrame:
    """Ticket updates from exposure snapshots."""
    rows = sources.table("exposure").select("creditor_id", F.col("amount_gbp").alias("fds_exposure_current"))
    if params.limit is not None:
        rows = rows.orderBy("creditor_id", "fds_exposure_current").limit(params.limit)
    rows = rows.withColumn("ticket_id", F.lit(settings.update_ticket_id).cast("bigint"))
    document = p.update_ticket(settings, params.exposure_value, params.fraud_score_value, params.body)
    return emit(rows, c.PROCESS_TICKET_UPDATE, **{c.UPDATE_TICKET: document})


def single_ticket(
    sources: Sources, as_of: date, params=c.SingleTicketParams(), settings=DEFAULT_SETTINGS
) -> DataFrame:
    """A reduced ticket for chosen creditors, matched on the organisation's."""
    rows = features.creditor_details(
        sources,
        exclude_payment_providers=False,
        managed=None,
        organisation_creditor_ids=params.creditor_ids,
    )
    document = p.create_short_ticket(
        settings, params.priority, p.single_body(settings, params.note), F.lit(params.subject)
    )
    return emit(rows, c.PROCESS_SINGLE_TICKET, **{c.CREATE_TICKET: document})


PIPELINES = {
    c.PROCESS_SCORE_DROP: score_drop,
    c.PROCESS_CHARGEBACK: chargeback,
    c.PROCESS_NEGATIVE_BALANCE: negative_balance,
    c.PROCESS_SANCTIONED: sanctioned_exposure,
    c.PROCESS_RE_REVIEW: re_review,
    c.PROCESS_INSOLVENCY: insolvency,
    c.PROCESS_ONBOARDING: high_risk_onboarding,
    c.PROCESS_TICKET_UPDATE: ticket_update,
    c.PROCESS_SINGLE_TICKET: single_ticket,
}


def run(
    name: str,
    sources: Sources,
    as_of: date,
    params: Any = None,
    settings: c.TicketSettings = DEFAULT_SETTINGS,
) -> DataFrame:
    """The result of the named process for a run date.

    The table is lazy. Where the session names a shared folder, building it runs
    and writes the staged parts of the process first; remove them with
    ``drop_staged`` once the result is written.
    """
    pipeline = PIPELINES[name]
    extra = {} if params is None else {"params": params}
    return pipeline(sources, as_of, settings=settings, **extra)
