"""Features, payloads and pipelines against the oracle."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import ctes as x
from checks.binding import AS_OF, sources, with_events, with_seen
from checks.params import CHARGEBACK, INSOLVENCY, QUALIFIER, RE_REVIEW, SCORE_DROP
from checks.registry import check
from riskwatch import config as c
from riskwatch.plans import features as f
from riskwatch.plans import merge, pipelines
from riskwatch.plans import payloads as p

SETTINGS = c.TicketSettings()
DETAIL_DATES = "most_recent_risk_label_created_at creditor_created_date"
STANDARD_DATES = "most_recent_risk_label_created_at db_failure_score_current_date prediction_calendar_date"
STANDARD_AMOUNTS = "fds_exposure_current nb_balance_current merchant_payment_amt_gbp_last_365d"


# --- Features ---------------------------------------------------------------


@check("fea1", x.query("SELECT * FROM details_active", DETAIL_DATES))
def fea1(spark, sf):
    """Creditor details of the score process: active, derived managed flag."""
    return f.creditor_details(sources(spark, sf), require_active=True, managed="derived")


@check("fea2", x.query("SELECT * FROM latest_exposure", "", "fds_exposure_current"))
def fea2(spark, sf):
    return f.latest_exposure(sources(spark, sf))


@check("fea3", x.query("SELECT * FROM latest_failure_score", "db_failure_score_current_date"))
def fea3(spark, sf):
    return f.latest_failure_score(sources(spark, sf))


@check("fea4", x.query(
    "SELECT * FROM score_change", "db_failure_score_current_date db_failure_score_last_date"))
def fea4(spark, sf):
    return f.failure_score_change(sources(spark, sf), AS_OF)


@check("fea5", x.query("SELECT * FROM latest_default_probability", "prediction_calendar_date"))
def fea5(spark, sf):
    return f.latest_default_probability(sources(spark, sf))


@check("fea6", x.query("SELECT * FROM yesterday_balance", "calendar_date", "balance_amount_sum_gbp"))
def fea6(spark, sf):
    return f.yesterday_balance(sources(spark, sf), AS_OF)


@check("fea7", x.query(
    "SELECT * FROM payment_metrics", "", "future_payments_7days merchant_payment_amt_gbp_last_365d"))
def fea7(spark, sf):
    return f.payment_window_metrics(sources(spark, sf), AS_OF)


@check("fea8", x.query(
    "SELECT * FROM payment_rates", "", "future_payments_7days merchant_payment_amt_gbp_last_365d"))
def fea8(spark, sf):
    return f.payment_rates(f.payment_window_metrics(sources(spark, sf), AS_OF))


@check("fea7_events", x.query(
    "SELECT * FROM payment_metrics", "", "future_payments_7days merchant_payment_amt_gbp_last_365d"))
def fea7_events(spark, sf):
    """From payments stored by event date."""
    return f.payment_window_metrics(with_events(spark, sf), AS_OF)


@check("fea9", x.query("SELECT * FROM paid_last_year", "", "merchant_payment_amt_gbp_last_365d"))
def fea9(spark, sf):
    return f.paid_last_year(sources(spark, sf), AS_OF)


@check("fea9_seen", x.query("SELECT * FROM paid_last_year", "", "merchant_payment_amt_gbp_last_365d"))
def fea9_seen(spark, sf):
    """With the kept table of paying creditors."""
    return f.paid_last_year(with_seen(spark, sf), AS_OF)


PEER_RATES = x.query("""
    SELECT creditor_id, merchant_category_code, mcc_chargeback_vol_last_12m, mcc_chargeback_rate_vol_last_12m,
           portfolio_chargeback_vol_last_12m, portfolio_chargeback_rate_vol_last_12m, reference_cb_rate
    FROM merged_chargeback""")


def _peer_rates(tables):
    _, categories = f.peer_totals(tables, AS_OF)
    rows = f.peer_reference_rate(f.creditor_details(tables), categories, CHARGEBACK.min_peer_chargebacks)
    return rows.select(
        "creditor_id", "merchant_category_code", "mcc_chargeback_vol_last_12m",
        "mcc_chargeback_rate_vol_last_12m", "portfolio_chargeback_vol_last_12m",
        "portfolio_chargeback_rate_vol_last_12m", "reference_cb_rate",
    )


@check("fea10", PEER_RATES)
def fea10(spark, sf):
    """Category, portfolio and fallback rate for every merchant."""
    return _peer_rates(sources(spark, sf))


@check("fea10_seen", PEER_RATES)
def fea10_seen(spark, sf):
    """Idle categories by the kept table of paying creditors."""
    return _peer_rates(with_seen(spark, sf))


@check("fea10_events", PEER_RATES)
def fea10_events(spark, sf):
    """From payments stored by event date."""
    return _peer_rates(with_events(spark, sf))


@check("fea11", x.query("SELECT * FROM chargeback_history", "chargeback_monitoring_date_last"))
def fea11(spark, sf):
    return f.last_alert(
        sources(spark, sf), AS_OF, c.PROCESS_CHARGEBACK, "cb_rate_30days", f.CHARGEBACK_HISTORY
    )


@check("fea12", x.query("SELECT * FROM review_tickets", "created_at next_review_date"))
def fea12(spark, sf):
    return f.ticket_review_dates(sources(spark, sf))


@check("fea13", x.query("SELECT * FROM sanctioned_tickets", "created_at"))
def fea13(spark, sf):
    return f.sanctioned_exposure(sources(spark, sf))


@check("fea14", x.query("SELECT * FROM latest_opportunity", "opportunity_created_date"))
def fea14(spark, sf):
    return f.latest_opportunity(sources(spark, sf))


@check("fea15", x.query(
    "SELECT * FROM merged_negative_balance",
    STANDARD_DATES + " neg_bal_monitoring_date_last", STANDARD_AMOUNTS))
def fea15(spark, sf):
    """The wide merge with history, before any rule."""
    return merge.negative_balance(sources(spark, sf), AS_OF)


# --- Payloads ---------------------------------------------------------------


def _ticket(column):
    return [F.col("creditor_id"), column.alias("payload")]


@check("pay1", x.query(f"""
    SELECT creditor_id, {x.create_ticket(x.BALANCE_BODY, x.subject('Negative Balance'),
                                         'credit__monitoring_nb')} AS payload
    FROM ruled_negative_balance"""))
def pay1(spark, sf):
    """Create-ticket document for every merchant."""
    return pipelines.negative_balance(sources(spark, sf), AS_OF).select(
        "creditor_id", F.col(c.CREATE_TICKET).alias("payload")
    )


@check("pay2", x.query(f"""
    SELECT creditor_id, {x.create_ticket(x.INSOLVENCY_BODY, "'This is s test do not Panic!!! 1'",
                                         None, assign=False)} AS payload
    FROM merged_insolvency"""))
def pay2(spark, sf):
    """Without assignee and with empty custom fields."""
    rows = merge.insolvency(sources(spark, sf), AS_OF, INSOLVENCY)
    return rows.select(*_ticket(
        p.create_ticket(SETTINGS, p.insolvency_body(), F.lit(INSOLVENCY.subject), tag=None, assign=False)
    ))


SHORT = f"""CAST(to_json({{'ticket': {{'priority': 'high', 'ticket_form_id': {SETTINGS.ticket_form_id},
    'comment': {{'body': '**Merchant Name:**' || merchant_name || 'This is a test


{SETTINGS.footer}', 'public': false}}, 'subject': 'TEST TEST TETSe - '}}}}) AS VARCHAR)"""


@check("pay3", x.query(f"SELECT creditor_id, {SHORT} AS payload FROM details"))
def pay3(spark, sf):
    rows = f.creditor_details(sources(spark, sf))
    body = p.single_body(SETTINGS, "This is a test")
    return rows.select(*_ticket(p.create_short_ticket(SETTINGS, "high", body, F.lit("TEST TEST TETSe - "))))


UPDATE = f"""CAST(to_json({{'ticket': {{'ticket_form_id': {SETTINGS.update_form_id},
    'custom_fields': [{{'id': CAST({SETTINGS.exposure_field_id} AS BIGINT), 'value': '55555'}},
                      {{'id': CAST({SETTINGS.fraud_score_field_id} AS BIGINT), 'value': '123'}}],
    'comment': {{'body': 'This is a test editing the ticket', 'public': false}}}}}}) AS VARCHAR)"""


@check("pay4", x.query(f"""
    SELECT creditor_id, CAST({SETTINGS.update_ticket_id} AS BIGINT) AS ticket_id, {UPDATE} AS payload
    FROM latest_exposure"""))
def pay4(spark, sf):
    document = p.update_ticket(SETTINGS, "55555", "123", "This is a test editing the ticket")
    ticket = F.lit(SETTINGS.update_ticket_id).cast("bigint").alias("ticket_id")
    return f.latest_exposure(sources(spark, sf)).select("creditor_id", ticket, document.alias("payload"))


@check("pay5", x.query(f"SELECT creditor_id, prev_ticket_id, {x.SANCTIONED_BODY} AS body FROM ruled_sanctioned"))
def pay5(spark, sf):
    """Markdown body of sections with defaults."""
    rows = pipelines.sanctioned_exposure(sources(spark, sf), AS_OF)
    return rows.select("creditor_id", "prev_ticket_id", p.sanctioned_body(SETTINGS).alias("body"))


@check("pay6", x.query(f"SELECT creditor_id, {x.CHARGEBACK_BODY} AS body FROM ruled_chargeback"))
def pay6(spark, sf):
    """The section that depends on history, for all merchants."""
    params = c.ChargebackParams(
        qualifier=QUALIFIER, min_peer_chargebacks=600, require_qualifier=False, only_alerts=False
    )
    rows = pipelines.chargeback(sources(spark, sf), AS_OF, params)
    return rows.select("creditor_id", p.chargeback_body(SETTINGS).alias("body"))


@check("pay7", x.query(f"""
    SELECT creditor_id, db_failure_score_last_date, {x.SCORE_BODY} AS body FROM ruled_score_drop""",
    "db_failure_score_last_date"))
def pay7(spark, sf):
    """Plain body; NULL without a score."""
    rows = merge.score_drop(sources(spark, sf), AS_OF)
    return rows.select("creditor_id", "db_failure_score_last_date", p.score_drop_body(SETTINGS).alias("body"))


@check("pay8", x.query(f"""
    SELECT creditor_id, {x.subject('D&B Score', '')} AS with_default, {x.subject('Re-Review')} AS without_default
    FROM details"""))
def pay8(spark, sf):
    return f.creditor_details(sources(spark, sf)).select(
        "creditor_id",
        p.subject("D&B Score", "").alias("with_default"),
        p.subject("Re-Review").alias("without_default"),
    )


# --- Pipelines --------------------------------------------------------------

PIP1 = f"""
    SELECT *, 'Credit_Monitoring_DNB' AS process_name,
           {x.create_ticket(x.SCORE_BODY, x.subject('D&B Score', ''), 'credit__monitoring_fs')}
               AS ActionField_ZendeskCreateTicket,
           false AS ActionField_FreezeAccount, false AS ActionField_DisablePayouts,
           CAST(NULL AS BIGINT) AS ActionField_ChangeHoldingPeriod,
           CAST(NULL AS BIGINT) AS ActionField_ApplyNegBalanceLimits
    FROM ruled_score_drop
    WHERE merchant_monitoring_qualifyer = 1 AND failure_score_monitoring_alert = 'New Alert'
      AND insolvency_flag = false AND db_failure_score_current_date = {x.YESTERDAY}"""


@check("pip1", x.query(PIP1, "db_failure_score_current_date db_failure_score_last_date", STANDARD_AMOUNTS))
def pip1(spark, sf):
    return pipelines.score_drop(sources(spark, sf), AS_OF, SCORE_DROP)


PIP2 = f"""
    SELECT *, 'credit_chargeback_monitoring' AS process_name,
           {x.create_ticket(x.CHARGEBACK_BODY, x.subject('Chargebacks', 'N/A'), 'credit__monitoring_cb')}
               AS ActionField_ZendeskCreateTicket
    FROM ruled_chargeback
    WHERE merchant_monitoring_qualifyer = 1 AND chargeback_monitoring_alert <> 'No Alert'"""
PIP2_AMOUNTS = STANDARD_AMOUNTS + (
    " mcc_payment_amt_last_12m mcc_chargeback_amt_last_12m"
    " portfolio_payment_amt_last_12m portfolio_chargeback_amt_last_12m"
)


@check("pip2", x.query(PIP2, STANDARD_DATES + " chargeback_monitoring_date_last", PIP2_AMOUNTS))
def pip2(spark, sf):
    return pipelines.chargeback(sources(spark, sf), AS_OF, CHARGEBACK)


PIP3 = f"""
    SELECT *, 'credit_negative_balance' AS process_name,
           {x.create_ticket(x.BALANCE_BODY, x.subject('Negative Balance'), 'credit__monitoring_nb')}
               AS ActionField_ZendeskCreateTicket
    FROM ruled_negative_balance"""


@check("pip3", x.query(PIP3, STANDARD_DATES + " neg_bal_monitoring_date_last", STANDARD_AMOUNTS))
def pip3(spark, sf):
    return pipelines.negative_balance(sources(spark, sf), AS_OF)


@check("pip3_thresholds", x.query(f"""
    FROM ({PIP3}) WHERE nb_alert_type <> 'No Alert' AND nb_balance_current <= -500 AND NOT insolvency_flag
      AND last_payment_days_ago <= 4000""",
    STANDARD_DATES + " neg_bal_monitoring_date_last", STANDARD_AMOUNTS))
def pip3_thresholds(spark, sf):
    """With every optional filter on."""
    params = c.NegativeBalanceParams(
        max_balance=-500, exclude_insolvent=True, only_alerts=True, max_last_payment_days=4000)
    return pipelines.negative_balance(sources(spark, sf), AS_OF, params)


PIP4 = f"""
    SELECT *, 'credit_sanctioned_exposure' AS process_name,
           {x.create_ticket(x.SANCTIONED_BODY, x.subject('Negative Balance'), 'credit__monitoring_nb')}
               AS ActionField_ZendeskCreateTicket
    FROM ruled_sanctioned"""


@check("pip4", x.query(PIP4, STANDARD_DATES + " created_at", STANDARD_AMOUNTS))
def pip4(spark, sf):
    return pipelines.sanctioned_exposure(sources(spark, sf), AS_OF)


PIP5 = f"""
    SELECT *, 'credit_re_review' AS process_name,
           {x.create_ticket(x.REVIEW_BODY, x.subject('Re-Review'), 'credit__monitoring_rr')}
               AS ActionField_ZendeskCreateTicket
    FROM ruled_re_review"""


@check("pip5", x.query(PIP5, STANDARD_DATES + " ticket_created_at next_review_date", STANDARD_AMOUNTS))
def pip5(spark, sf):
    return pipelines.re_review(sources(spark, sf), AS_OF, RE_REVIEW)


PIP6 = f"""
    SELECT *, 'credit_insolvency' AS process_name,
           {x.create_ticket(x.INSOLVENCY_BODY, "'This is s test do not Panic!!! 1'", None, assign=False)}
               AS ActionField_ZendeskCreateTicket
    FROM ruled_insolvency"""


@check("pip6", x.query(
    PIP6, "most_recent_risk_label_created_at", "fds_exposure_current merchant_payment_amt_gbp_last_365d"))
def pip6(spark, sf):
    return pipelines.insolvency(sources(spark, sf), AS_OF, INSOLVENCY)


@check("pip7", x.query("SELECT * FROM onboarding_decided", "created_date", "payment_gbp_amount_in_all_time"))
def pip7(spark, sf):
    return pipelines.high_risk_onboarding(sources(spark, sf), AS_OF)


@check("pip8", x.query(f"""
    SELECT creditor_id, amount_gbp AS fds_exposure_current,
           CAST({SETTINGS.update_ticket_id} AS BIGINT) AS ticket_id, 'Test_Oct15' AS process_name,
           {UPDATE} AS ActionField_ZendeskUpdateTicket
    FROM exposure""", "", "fds_exposure_current"))
def pip8(spark, sf):
    return pipelines.ticket_update(sources(spark, sf), AS_OF, c.TicketUpdateParams())


PINNED = tuple(f"CR{4 * group}" for group in range(1, 40))


@check("pip9", x.query(f"""
    SELECT * EXCLUDE (managed_label, is_cs_managed, csm_owner_name), 'test_nov21' AS process_name,
           {SHORT} AS ActionField_ZendeskCreateTicket
    FROM joined WHERE EXISTS (FROM organisation pin WHERE pin.organisation_id = joined.organisation_id
        AND pin.creditor_id IN ({", ".join(f"'{i}'" for i in PINNED)}))""", DETAIL_DATES))
def pip9(spark, sf):
    """Pinned to the organisation's creditor."""
    return pipelines.single_ticket(sources(spark, sf), AS_OF, c.SingleTicketParams(creditor_ids=PINNED))


@check("pip8_limit", x.query(f"""
    SELECT creditor_id, amount_gbp AS fds_exposure_current,
           CAST({SETTINGS.update_ticket_id} AS BIGINT) AS ticket_id, 'Test_Oct15' AS process_name,
           {UPDATE} AS ActionField_ZendeskUpdateTicket
    FROM exposure ORDER BY creditor_id, amount_gbp LIMIT 1""", "", "fds_exposure_current"))
def pip8_limit(spark, sf):
    """The dry-run limit."""
    return pipelines.ticket_update(sources(spark, sf), AS_OF, c.TicketUpdateParams(limit=1))
