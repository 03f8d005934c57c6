"""Processes end to end on hand-made rows; payloads are parsed back."""

import json
from dataclasses import replace
from datetime import date, datetime

import pytest

from riskwatch import PIPELINES, run
from riskwatch import config as c
from riskwatch.sources import as_log_rows, write_results
from tests.tables import (AS_OF, MERCHANT, ORGANISATION, by_key, charged_back, days, make_sources, on, paid,
                          report)

LARGE = [{"creditor_id": "C1", "amount_gbp": 600000.25, "calculated_at_date": on(-1)}]
FULL_MERCHANT = {
    **MERCHANT, "name": 'Shop "é"\n2', "geo": "GB", "merchant_category_code": "a",
    "merchant_category_code_description": "retail", "creditor_risk_label_detail": "insolvency",
    "most_recent_risk_label_created_at": days(-5),
}
FULL_ORGANISATION = {
    **ORGANISATION, "current_revenue_account_type": "direct", "parent_account_id": "P1", "parent_account_name": "Parent",
}


def ticket(row):
    return json.loads(row[c.CREATE_TICKET])["ticket"]


def test_score_drop(spark):
    tables = make_sources(spark, creditor=[MERCHANT], organisation=[ORGANISATION], exposure=LARGE,
                          score_report=[report("C1", days(-9), 60), report("C1", days(-1), 40)])
    row = by_key(run(c.PROCESS_SCORE_DROP, tables, AS_OF))["C1"]
    assert row["failure_score_monitoring_alert"] == c.NEW_ALERT
    made = ticket(row)
    assert list(made) == ["priority", "brand_id", "group_id", "requester_id", "ticket_form_id", "assignee_id",
                          "custom_fields", "comment", "subject"]
    assert made["custom_fields"] == [{"id": 28480929, "value": "credit__monitoring_fs"}]
    assert made["subject"] == "Credit Monitoring - D&B Score - Shop - C1"
    body = made["comment"]["body"].split("\n")
    assert body[0] == "Creditor ID: C1"
    assert "FDS Exposure: 600000.25" in body and "Negative Balance: 0" in body
    assert body[-6:-3] == ["Current D&B Score: 40", "Previous D&B Score: 60", "Score Change: -20"]
    assert "Payments last 12m: " in body
    assert made["comment"]["public"] is False
    assert (row[c.FREEZE_ACCOUNT], row[c.DISABLE_PAYOUTS]) == (False, False)
    assert (row[c.CHANGE_HOLDING_PERIOD], row[c.APPLY_BALANCE_LIMITS]) == (None, None)


def test_score_drop_leaves_out_insolvent_merchants(spark):
    tables = make_sources(spark, creditor=[{**MERCHANT, "creditor_risk_label_detail": "liquidation"}],
                          organisation=[ORGANISATION], exposure=LARGE,
                          score_report=[report("C1", days(-9), 60), report("C1", days(-1), 40)])
    assert run(c.PROCESS_SCORE_DROP, tables, AS_OF).count() == 0
    keep = c.ScoreDropParams(exclude_insolvent=False)
    assert run(c.PROCESS_SCORE_DROP, tables, AS_OF, keep).count() == 1


def chargeback_sources(spark, **more):
    payments = [paid("C1", -3)] * 3 + [charged_back("C1", -3)] + [paid("C2", -3)] * 7
    creditors = [{**MERCHANT, "merchant_category_code": "a"}, {**MERCHANT, "id": "C2", "merchant_category_code": "a"}]
    return make_sources(spark, **{"creditor": creditors, "organisation": [ORGANISATION], "exposure": LARGE,
                                  "payment": payments, **more})


def test_chargeback_first_alert(spark):
    row = by_key(run(c.PROCESS_CHARGEBACK, chargeback_sources(spark), AS_OF))["C1"]
    assert row["chargeback_monitoring_alert"] == c.NEW_ALERT
    assert (row["cb_rate_30days"], row["reference_cb_rate"]) == (1 / 3, 0.1)
    body = ticket(row)["comment"]["body"]
    assert "**FDS Exposure:** £600,000.3\n" in body
    assert "**Case Type:** New Alert\n**CB Rate:** 33.33%\n**Reference CB Rate:** 10.00%\n\n" in body
    assert "Previous ticket" not in body
    assert "[C1](https://admin.example.com/creditors/C1)" in body


def test_chargeback_uses_the_category_rate_when_it_is_large_enough(spark):
    creditors = [{**MERCHANT, "merchant_category_code": "a"}, {**MERCHANT, "id": "C2", "merchant_category_code": "b"}]
    row = by_key(run(c.PROCESS_CHARGEBACK, chargeback_sources(spark, creditor=creditors), AS_OF,
                     c.ChargebackParams(min_peer_chargebacks=1, only_alerts=False)))["C1"]
    assert row["reference_cb_rate"] == 1 / 3
    assert row["chargeback_monitoring_alert"] == c.NO_ALERT


@pytest.mark.parametrize("ticket_id, known", [('"77"', True), ("null", False)])
def test_chargeback_history_needs_a_ticket_id(spark, ticket_id, known):
    log = [{"values": f'{{"creditor_id":"C1","ticket_id":{ticket_id},"cb_rate_30days":0.125}}', "runtime": days(-5),
            "logtype": "result", "process_name": c.PROCESS_CHARGEBACK}]
    row = by_key(run(c.PROCESS_CHARGEBACK, chargeback_sources(spark, result_log=log), AS_OF))["C1"]
    assert row["chargeback_monitoring_alert"] == c.CHARGEBACK_INCREASE
    body = ticket(row)["comment"]["body"]
    if known:
        assert "[77](https://tickets.example.com/agent/tickets/77)\n**CB Rate Previously:** 12.50%" in body
        assert "**Days Since Last Trigger:** 5\n\n" in body
    else:
        assert body is None


def test_results_come_back_through_the_log(spark):
    tables = chargeback_sources(spark)
    first = run(c.PROCESS_CHARGEBACK, tables, AS_OF)
    logged = as_log_rows(first, datetime(2024, 11, 7, 8), ("cb_rate_30days",))
    again = tables.replace(result_log=logged)
    assert run(c.PROCESS_CHARGEBACK, again, date(2024, 11, 8)).count() == 0
    history = run(c.PROCESS_CHARGEBACK, again, date(2024, 11, 8), c.ChargebackParams(only_alerts=False))
    assert by_key(history)["C1"]["chargeback_monitoring_rate_last"] == 1 / 3


def test_written_results_can_be_read_by_process(spark, tmp_path):
    rows = run(c.PROCESS_CHARGEBACK, chargeback_sources(spark), AS_OF)
    for run_date in (AS_OF, date(2024, 11, 8), AS_OF):
        write_results(rows, str(tmp_path / "out"), run_date)
    back = spark.read.parquet(str(tmp_path / "out")).where(f"process_name = '{c.PROCESS_CHARGEBACK}'")
    # A repeated run replaces its own rows only.
    assert sorted(r["run_date"] for r in back.collect()) == [AS_OF, date(2024, 11, 8)]


def test_negative_balance(spark):
    balance = [{"owner_id": "C1", "name": c.BALANCE_NAME, "calendar_date": on(-1), "balance_amount_sum_gbp": -2500.5}]
    log = [{"values": '{"creditor_id":"C1","nb_balance_current":-1000}', "runtime": days(-5), "logtype": "result",
            "process_name": c.PROCESS_NEGATIVE_BALANCE}]
    creditors = [MERCHANT, {**MERCHANT, "id": "C2", "name": None}]
    tables = make_sources(spark, creditor=creditors, organisation=[ORGANISATION], daily_balance=balance, result_log=log)
    rows = by_key(run(c.PROCESS_NEGATIVE_BALANCE, tables, AS_OF))
    assert rows["C1"]["nb_alert_type"] == c.BALANCE_DOUBLED
    assert rows["C1"]["NB_Increase"] == 1500.5
    body = ticket(rows["C1"])["comment"]["body"]
    assert "[N/A](https://tickets.example.com/agent/tickets/N/A)" in body
    assert "**Previous NB:** -1,000.00\n**NB Now:** -2,500.50\n**NB Increase:** 1,500.50\n\n" in body
    # Without history, and with a subject that does not survive a missing name.
    assert rows["C2"]["nb_alert_type"] == c.NEW_ALERT
    assert ticket(rows["C2"])["subject"] is None
    assert "**Case Type:** New Alert\n**NB Now:** 0.00\n\n" in ticket(rows["C2"])["comment"]["body"]


def test_negative_balance_filters_are_off_by_default(spark):
    tables = make_sources(spark, creditor=[MERCHANT, {**MERCHANT, "id": "C2"}], organisation=[ORGANISATION])
    count = lambda **k: run(c.PROCESS_NEGATIVE_BALANCE, tables, AS_OF, c.NegativeBalanceParams(**k)).count()
    assert count() == 2
    assert count(max_balance=-1) == 0
    assert count(creditor_ids=("C2",)) == 1
    assert count(max_last_payment_days=40) == 0


def test_sanctioned_exposure(spark):
    tables = make_sources(
        spark, creditor=[MERCHANT], organisation=[ORGANISATION], exposure=LARGE,
        ticket=[{"id": 1, "created_at": days(-9), "organization_id": 1, "group_id": 1}],
        ticket_group=[{"id": 1, "name": "Credit"}], ticket_org=[{"id": 1, "organisation_key": "O1"}],
        ticket_field=[{"ticket_id": 1, "ticket_field_title": c.FIELD_SANCTIONED_AMOUNT, "ticket_field_value": "400000"}])
    row = by_key(run(c.PROCESS_SANCTIONED, tables, AS_OF))["C1"]
    made = ticket(row)
    assert row["FDS_Increase"] == pytest.approx(1.50000075)
    assert "**Current FDS in % of sanctioned amount:**150.0%" in made["comment"]["body"]
    assert made["comment"]["body"].count("FDS Exposure") == 2
    assert made["subject"] == "Credit Monitoring - Negative Balance - Shop - C1"
    assert made["custom_fields"][0]["value"] == "credit__monitoring_nb"


def test_re_review_multiplies_tickets_and_creditors(spark):
    tickets = [{"id": i, "created_at": days(-i), "subject": "s", "organization_id": 1} for i in (1, 2, 3)]
    dates = {1: "2024-11-07", 2: "2024-11-08", 3: "2024-11-09"}
    tables = make_sources(
        spark, creditor=[MERCHANT, {**MERCHANT, "id": "C2"}], organisation=[ORGANISATION], ticket=tickets,
        ticket_org=[{"id": 1, "organisation_key": "O1"}],
        ticket_field=[{"ticket_id": i, "ticket_field_title": c.FIELD_NEXT_REVIEW, "ticket_field_value": d}
                      for i, d in dates.items()])
    rows = run(c.PROCESS_RE_REVIEW, tables, AS_OF).collect()
    assert sorted((r["creditor_id"], r["ticket_id"]) for r in rows) == [("C1", 1), ("C1", 2), ("C2", 1), ("C2", 2)]
    body = ticket(rows[0])["comment"]["body"]
    assert "**Current Negative Balance:** £0.0\n" in body and "**Stated review reason:** N/A" in body
    some = c.ReReviewParams(review_dates=(date(2024, 11, 9),))
    assert run(c.PROCESS_RE_REVIEW, tables, AS_OF, some).count() == 2


def test_insolvency(spark):
    creditors = [FULL_MERCHANT, {**FULL_MERCHANT, "id": "C2", "geo": None},
                 {**FULL_MERCHANT, "id": "C3", "most_recent_risk_label_created_at": datetime(2024, 9, 3, 23, 59)}]
    tables = make_sources(
        spark, creditor=creditors, organisation=[FULL_ORGANISATION],
        exposure=[{"creditor_id": i, "amount_gbp": 99999.96, "calculated_at_date": on(-1)} for i in ("C1", "C2", "C3")],
        payment=[paid(i, -1) for i in ("C1", "C2", "C3")])
    rows = by_key(run(c.PROCESS_INSOLVENCY, tables, AS_OF, c.InsolvencyParams(limit=None)))
    # 99,999.96 rounds up to the limit; the label of C3 is too old.
    assert set(rows) == {"C1", "C2"}
    made = ticket(rows["C1"])
    assert made["custom_fields"] == [] and "assignee_id" not in made
    assert made["comment"]["body"].startswith('Creditor ID: C1\nOrganisation ID: O1\nMerchant name: Shop "é"\n2\nGeo: GB')
    assert made["comment"]["body"].endswith("Payments last 12m: 10\nFDS Exposure: 100000")
    assert ticket(rows["C2"])["comment"]["body"] is None
    assert set(by_key(run(c.PROCESS_INSOLVENCY, tables, AS_OF))) == {"C1", "C2"}
    dry = run(c.PROCESS_INSOLVENCY, tables, AS_OF, c.InsolvencyParams(limit=1))
    assert [r["creditor_id"] for r in dry.collect()] == ["C1"]


def test_onboarding_has_plain_columns(spark):
    tables = make_sources(spark, creditor=[MERCHANT], organisation=[
        {**ORGANISATION, "created_at": days(0), "merchant_category_code": "8249"}])
    row = by_key(run(c.PROCESS_ONBOARDING, tables, AS_OF))["C1"]
    assert row["freeze_account_action"] and row["create_zendesk_ticket"] and not row["restricted_industry"]
    assert "process_name" not in row


def test_ticket_update(spark):
    tables = make_sources(spark, exposure=LARGE * 3)
    assert run(c.PROCESS_TICKET_UPDATE, tables, AS_OF).count() == 3 * len(LARGE)
    rows = run(c.PROCESS_TICKET_UPDATE, tables, AS_OF, c.TicketUpdateParams(limit=1)).collect()
    assert len(rows) == 1 and rows[0]["ticket_id"] == 3417983
    made = json.loads(rows[0][c.UPDATE_TICKET])["ticket"]
    assert list(made) == ["ticket_form_id", "custom_fields", "comment"]
    assert made["custom_fields"] == [{"id": 15542500163356, "value": "55555"}, {"id": 15545615128732, "value": "123"}]


def test_single_ticket_matches_the_organisations_creditor(spark):
    tables = make_sources(spark, organisation=[ORGANISATION],
                          creditor=[{**MERCHANT, "id": "C9", "is_payment_provider": True}])
    rows = run(c.PROCESS_SINGLE_TICKET, tables, AS_OF, c.SingleTicketParams(creditor_ids=("C1",))).collect()
    assert [r["creditor_id"] for r in rows] == ["C9"]
    made = ticket(rows[0])
    assert list(made) == ["priority", "ticket_form_id", "comment", "subject"] and made["priority"] == "high"
    other = c.SingleTicketParams(creditor_ids=("C9",))
    assert run(c.PROCESS_SINGLE_TICKET, tables, AS_OF, other).count() == 0


def test_settings_reach_the_ticket(spark):
    settings = replace(c.TicketSettings(), brand_id=7, ticket_url="https://t/", footer="Made here")
    tables = make_sources(spark, creditor=[MERCHANT], organisation=[ORGANISATION])
    row = run(c.PROCESS_NEGATIVE_BALANCE, tables, AS_OF, settings=settings).first()
    made = ticket(row)
    assert made["brand_id"] == 7 and made["comment"]["body"].endswith("\n\n\nMade here")


def test_every_process_runs_on_empty_tables(spark):
    for name in PIPELINES:
        assert run(name, make_sources(spark), AS_OF).count() == 0


def test_sources_name_what_is_missing(spark):
    tables = make_sources(spark).replace(exposure=spark.createDataFrame([], "creditor_id string"))
    with pytest.raises(ValueError, match="amount_gbp"):
        tables.table("exposure")
    with pytest.raises(ValueError, match="unknown"):
        tables.replace(nonsense=spark.range(1))
