"""Hand-made source tables: name the columns that matter, the rest is NULL."""

from datetime import date, datetime, timedelta
from functools import partial

from riskwatch.sources import Sources

AS_OF = date(2024, 11, 7)

SCHEMAS = {
    "creditor": """id string, organisation_id string, name string, geo string, merchant_category_code string,
        merchant_category_code_description string, creditor_risk_label_parent string,
        creditor_risk_label_detail string, most_recent_risk_label_created_at timestamp,
        creditor_created_date date, is_account_closed boolean, is_payment_provider boolean,
        organisation_with_multiple_creditors boolean""",
    "organisation": """organisation_id string, creditor_id string, name string, geo string, account_id string,
        merchant_category_code string, created_at timestamp, current_revenue_account_type string,
        current_state string, parent_account_id string, parent_account_name string, is_cs_managed boolean,
        csm_owner_name string, is_cs_managed_salesforce boolean, parent_account_stage string""",
    "organisation_fact": "organisation_id string, total_payment_gbp_amount_in_all_time double",
    "opportunity": "account_id string, opportunity_id string, opportunity_created_date date",
    "exposure": "creditor_id string, amount_gbp double, calculated_at_date date",
    "score_report": """creditor_id string, retrieved_at timestamp,
        dnb_assessment struct<failure_score: struct<national_percentile: bigint>>,
        legal_events struct<has_insolvency: boolean>""",
    "default_prediction": "creditor_id string, prediction_date string, probability double",
    "daily_balance": "owner_id string, name string, calendar_date date, balance_amount_sum_gbp double",
    "payment": """creditor_id string, amount_gbp double, is_paid boolean, is_charged_back boolean,
        is_failed boolean, is_late_failure boolean, is_refunded boolean, charge_date timestamp,
        charged_back_date timestamp, failed_or_late_failure_date timestamp, refund_created_at timestamp""",
    "ticket": "id bigint, created_at timestamp, subject string, organization_id bigint, group_id bigint",
    "ticket_field": "ticket_id bigint, ticket_field_title string, ticket_field_value string",
    "ticket_group": "id bigint, name string",
    "ticket_org": "id bigint, organisation_key string",
    "result_log": "`values` string, runtime timestamp, logtype string, process_name string",
}

MERCHANT = {"id": "C1", "organisation_id": "O1", "name": "Shop", "is_payment_provider": False}
ORGANISATION = {"organisation_id": "O1", "creditor_id": "C1", "current_state": "active"}


def make_table(spark, name, rows):
    empty = spark.createDataFrame([], SCHEMAS[name])
    unknown = {k for row in rows for k in row} - set(empty.columns)
    assert not unknown, unknown
    return spark.createDataFrame([tuple(r.get(c) for c in empty.columns) for r in rows], empty.schema)


def make_sources(spark, **tables):
    """Every logical table, empty unless given as a list of dicts."""
    return Sources({name: partial(make_table, spark, name, tables.get(name, [])) for name in SCHEMAS})


def days(n):
    """Noon, ``n`` days from the run date."""
    return datetime(AS_OF.year, AS_OF.month, AS_OF.day, 12) + timedelta(days=n)


def on(n):
    return AS_OF + timedelta(days=n)


def report(creditor, when, score, insolvent=False):
    return {
        "creditor_id": creditor,
        "retrieved_at": when,
        "dnb_assessment": ((score,),),
        "legal_events": (insolvent,),
    }


def paid(creditor, n, amount=10.0):
    return {"creditor_id": creditor, "amount_gbp": amount, "is_paid": True, "charge_date": days(n)}


def charged_back(creditor, n, amount=10.0):
    return {
        "creditor_id": creditor, "amount_gbp": amount, "is_charged_back": True, "charged_back_date": days(n),
    }


def by_key(df, key="creditor_id"):
    """Rows as dicts by key; fails when the key is not unique."""
    rows = [r.asDict() for r in df.collect()]
    found = {r[key]: r for r in rows}
    assert len(found) == len(rows)
    return found
