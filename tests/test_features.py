"""Features on hand-made rows, quirk by quirk."""

from datetime import date, timedelta
from decimal import Decimal

import pytest

from riskwatch import config as c
from riskwatch.plans import features as f
from tests.tables import AS_OF, MERCHANT, ORGANISATION, by_key, charged_back, days, make_sources, on, paid, report


def test_unknown_provider_flag_drops_the_creditor(spark):
    creditors = [MERCHANT, {**MERCHANT, "id": "C2", "is_payment_provider": None},
                 {**MERCHANT, "id": "C3", "is_payment_provider": True}]
    tables = make_sources(spark, creditor=creditors, organisation=[ORGANISATION])
    assert set(by_key(f.creditor_details(tables))) == {"C1"}
    assert len(by_key(f.creditor_details(tables, exclude_payment_providers=False))) == 3


def test_only_some_processes_need_an_active_organisation(spark):
    creditors = [{**MERCHANT, "id": f"C{i}", "organisation_id": f"O{i}"} for i in range(4)]
    organisations = [{**ORGANISATION, "organisation_id": "O0"},
                     {**ORGANISATION, "organisation_id": "O1", "current_state": "preactive"},
                     {**ORGANISATION, "organisation_id": "O2", "current_state": None}]
    tables = make_sources(spark, creditor=creditors, organisation=organisations)
    assert len(by_key(f.creditor_details(tables))) == 4
    assert set(by_key(f.creditor_details(tables, require_active=True))) == {"C0"}


@pytest.mark.parametrize("label, flag", [("liquidation", True), ("in_review", False), (None, False)])
def test_insolvency_flag_is_never_unknown(spark, label, flag):
    tables = make_sources(spark, creditor=[{**MERCHANT, "creditor_risk_label_detail": label}])
    assert by_key(f.creditor_details(tables))["C1"]["insolvency_flag"] is flag


def test_managed_label_from_flag_or_stage(spark):
    cases = {"O0": (True, None, "Yes"), "O1": (None, "CS Managed - SB", "Yes"), "O2": (False, "Self", "No"),
             "O3": (None, None, "No")}
    tables = make_sources(
        spark,
        creditor=[{**MERCHANT, "id": o, "organisation_id": o} for o in cases],
        organisation=[{**ORGANISATION, "organisation_id": o, "is_cs_managed_salesforce": a, "parent_account_stage": b}
                      for o, (a, b, _) in cases.items()],
    )
    rows = by_key(f.creditor_details(tables, managed="derived"))
    assert {o: rows[o]["is_cs_managed"] for o in cases} == {o: x for o, (_, _, x) in cases.items()}


def test_latest_exposure_breaks_ties_by_amount(spark):
    rows = [{"creditor_id": "C1", "amount_gbp": a, "calculated_at_date": on(d)}
            for a, d in [(900.0, -3), (10.0, -1), (20.0, -1)]]
    rows.append({"creditor_id": "C2", "amount_gbp": 5.0, "calculated_at_date": None})
    found = by_key(f.latest_exposure(make_sources(spark, exposure=rows)))
    assert found["C1"]["fds_exposure_current"] == Decimal("20.00")
    assert found["C2"]["fds_exposure_current"] == Decimal("5.00")


def test_latest_score_skips_reports_without_one(spark):
    rows = [report("C1", days(-2), 40), report("C1", days(-1), None), report("C2", days(-1), None)]
    found = by_key(f.latest_failure_score(make_sources(spark, score_report=rows)))
    assert set(found) == {"C1"}
    assert (found["C1"]["db_failure_score_current"], found["C1"]["rowno"]) == (40, 1)


def changes(spark, *reports):
    rows = f.failure_score_change(make_sources(spark, score_report=list(reports)), AS_OF).collect()
    return sorted((r["creditor_id"], r["db_failure_score_current"], r["db_failure_score_last"],
                   r["db_failure_score_last_date"], r["db_failure_score_change"]) for r in rows)


def test_first_report_compares_with_itself(spark):
    assert changes(spark, report("C1", days(-1), 40)) == [("C1", 40, 40, on(-1), 0)]


def test_change_runs_over_history_before_the_day_is_cut_out(spark):
    found = changes(spark, report("C1", days(-30), 90), report("C1", days(-10), 70), report("C1", days(-1), 55),
                    report("C2", days(-2), 10), report("C3", days(0), 1))
    assert found == [("C1", 55, 70, on(-10), -15)]


def test_two_reports_yesterday_are_two_rows(spark):
    early, late = days(-1) - timedelta(hours=5), days(-1)
    found = changes(spark, report("C1", days(-3), 80), report("C1", late, 50), report("C1", early, 60),
                    report("C1", early + timedelta(minutes=1), None))
    assert found == [("C1", 50, 60, on(-1), -10), ("C1", 60, 80, on(-3), -20)]


def test_default_probability_reads_compact_dates(spark):
    rows = [{"creditor_id": "C1", "prediction_date": d, "probability": p} for d, p in
            [("20241101", 0.1), ("20241106", 0.2)]]
    found = by_key(f.latest_default_probability(make_sources(spark, default_prediction=rows)))["C1"]
    assert (found["prediction_calendar_date"], found["PD_score_latest"]) == (date(2024, 11, 6), 0.2)


def test_balance_takes_one_day_and_one_fund(spark):
    name = c.BALANCE_NAME
    rows = [{"owner_id": "C1", "name": n, "calendar_date": on(d), "balance_amount_sum_gbp": a} for n, d, a in
            [(name, -1, -10.0), (name, -1, 4.5), (name, -2, 99.0), (name, 0, 99.0), ("other", -1, 99.0)]]
    found = by_key(f.yesterday_balance(make_sources(spark, daily_balance=rows), AS_OF))["C1"]
    assert (found["balance_amount_sum_gbp"], found["calendar_date"]) == (Decimal("-5.50"), on(-1))


def test_window_edges(spark):
    tables = make_sources(spark, payment=[paid("C1", n) for n in (0, -1, -30, -31, -90, -91, -365, -366, 7)])
    row = by_key(f.payment_window_metrics(tables, AS_OF))["C1"]
    assert row["merchant_payment_vol_last_30d"] == 2
    assert row["merchant_payment_vol_last_90d"] == 4
    assert row["merchant_payment_amt_gbp_last_365d"] == Decimal("60.00")
    assert (row["last_payment_days_ago"], row["newest_payment_days_ago"]) == (365, 1)
    # Charges of today and the next week are not let in by the past windows.
    assert row["future_payments_7days"] == 0


def test_next_week_counts_when_another_date_lets_the_row_in(spark):
    row = {**paid("C1", 3), "refund_created_at": days(-5)}
    assert by_key(f.payment_window_metrics(make_sources(spark, payment=[row]), AS_OF))["C1"][
        "future_payments_7days"] == Decimal("10.00")


def test_unknown_flags_do_not_count(spark):
    row = {"creditor_id": "C1", "amount_gbp": 5.0, "charge_date": days(-1), "is_paid": None}
    found = by_key(f.payment_window_metrics(make_sources(spark, payment=[row]), AS_OF))["C1"]
    assert (found["merchant_payment_vol_last_30d"], found["merchant_payment_amt_gbp_last_365d"]) == (0, 0)


def test_rate_without_volume_is_unknown(spark):
    tables = make_sources(spark, payment=[charged_back("C1", -5), paid("C2", -5), charged_back("C2", -5)])
    rows = by_key(f.payment_rates(f.payment_window_metrics(tables, AS_OF)))
    assert rows["C1"]["cb_rate_30days"] is None
    assert rows["C2"]["cb_rate_30days"] == 1.0


def test_one_pass_gives_the_windowed_metrics(spark):
    payments = [paid("C1", -20), charged_back("C1", -200), charged_back("C2", -200), paid("C3", -400),
                {**paid("C4", 2), "failed_or_late_failure_date": days(-3), "is_failed": True}]
    tables = make_sources(spark, payment=payments)
    narrow = f.payment_window_metrics(tables, AS_OF).drop("last_payment_days_ago", "newest_payment_days_ago")
    assert by_key(f.windowed_part(f.payment_activity(tables, AS_OF))) == by_key(narrow)
    assert set(by_key(narrow)) == {"C1", "C4"}


def test_category_counts_chargebacks_the_creditor_windows_miss(spark):
    creditors = [{**MERCHANT, "id": i, "merchant_category_code": m, "is_payment_provider": p} for i, m, p in
                 [("C1", "a", False), ("C2", "a", False), ("C3", None, False), ("C4", "a", None), ("C5", "b", False),
                  ("C6", "unused", False)]]
    payments = [paid("C1", -20), charged_back("C2", -200), paid("C3", -1), paid("C4", -1), paid("C5", -500),
                paid("unknown", -1)]
    tables = make_sources(spark, creditor=creditors, payment=payments)
    activity, categories = f.peer_totals(tables, AS_OF)
    rows = by_key(categories, "merchant_category_code")
    assert set(rows) == {"a", None, "b"}
    assert (rows["a"]["mcc_payment_vol_last_12m"], rows["a"]["mcc_chargeback_vol_last_12m"]) == (1, 1)
    assert rows["a"]["mcc_chargeback_rate_vol_last_12m"] == 1.0
    # Only old payments: present with zeros, and no rate.
    assert rows["b"]["mcc_payment_vol_last_12m"] == 0
    assert rows["b"]["mcc_chargeback_rate_vol_last_12m"] is None
    total = f.portfolio_totals(categories).collect()
    assert len(total) == 1 and total[0]["portfolio_payment_vol_last_12m"] == 2


def test_portfolio_of_nothing_is_one_unknown_row(spark):
    tables = make_sources(spark, creditor=[MERCHANT])
    row = f.portfolio_totals(f.peer_totals(tables, AS_OF)[1]).collect()
    assert len(row) == 1 and row[0]["portfolio_chargeback_rate_vol_last_12m"] is None


def log(values, n, process=c.PROCESS_CHARGEBACK, logtype="result"):
    return {"values": values, "runtime": days(n), "logtype": logtype, "process_name": process}


def test_last_alert_takes_the_newest_result_of_the_process(spark):
    rows = [
        log('{"creditor_id":"C1","ticket_id":"1","cb_rate_30days":0.5}', -95),
        log('{"creditor_id":"C1","ticket_id":null,"cb_rate_30days":"0.25"}', -90),
        log('{"creditor_id":"C1","ticket_id":"3","cb_rate_30days":0.9}', -1, logtype="debug"),
        log('{"creditor_id":"C1","ticket_id":"4","cb_rate_30days":0.9}', -1, process="other"),
    ]
    tables = make_sources(spark, result_log=rows)
    found = by_key(f.last_alert(tables, AS_OF, c.PROCESS_CHARGEBACK, "cb_rate_30days", f.CHARGEBACK_HISTORY))["C1"]
    assert found["ticket_id"] is None
    assert found["chargeback_monitoring_rate_last"] == 0.25
    assert found["chargeback_monitoring_days_since"] == 90
    assert found["chargeback_monitoring_trigger_last"] is True


def field(ticket, title, value):
    return {"ticket_id": ticket, "ticket_field_title": title, "ticket_field_value": value}


def test_review_dates_need_a_readable_date(spark):
    tickets = [{"id": i, "created_at": days(-i), "subject": f"s{i}", "organization_id": 1} for i in (1, 2, 3, 4)]
    fields = [field(1, c.FIELD_NEXT_REVIEW, "2024-11-07"), field(1, c.FIELD_REVIEW_REASON, "volume"),
              field(2, c.FIELD_NEXT_REVIEW, "next week"), field(3, c.FIELD_REVIEW_REASON, "no date"),
              field(1, "Something else", "x")]
    owners = [{"id": 1, "organisation_key": "O1"}]
    found = by_key(f.ticket_review_dates(
        make_sources(spark, ticket=tickets, ticket_field=fields, ticket_org=owners)), "ticket_id")
    assert set(found) == {1}
    assert found[1]["next_review_date"] == date(2024, 11, 7)
    assert (found[1]["reason_for_next_review"], found[1]["organisation_id"]) == ("volume", "O1")


def test_review_ticket_of_an_unknown_organisation_stays(spark):
    tickets = [{"id": 1, "created_at": days(-1), "subject": None, "organization_id": 9}]
    found = f.ticket_review_dates(
        make_sources(spark, ticket=tickets, ticket_field=[field(1, c.FIELD_NEXT_REVIEW, "2024-11-07")])).collect()
    assert [r["organisation_id"] for r in found] == [None]


def sanctioned(spark, tickets, fields, **more):
    base = {
        "ticket_group": [{"id": 1, "name": "Credit"}, {"id": 2, "name": "Fraud"}],
        "ticket_org": [{"id": 1, "organisation_key": "O1"}],
        "organisation": [ORGANISATION],
    }
    rows = [{"id": i, "created_at": days(-i), "organization_id": 1, "group_id": g} for i, g in tickets.items()]
    return by_key(f.sanctioned_exposure(make_sources(spark, ticket=rows, ticket_field=fields, **{**base, **more})))


def test_sanctioned_amounts_compare_as_text(spark):
    fields = [field(1, c.FIELD_SANCTIONED_AMOUNT, a) for a in ("9", "10")]
    assert sanctioned(spark, {1: 1}, fields)["C1"]["Sanctioned_Credit_Risk_Exposure"] == "9"


def test_newest_sanctioned_date_wins_after_the_amount_filter(spark):
    fields = [field(1, c.FIELD_SANCTIONED_AMOUNT, "100"), field(1, c.FIELD_SANCTIONED_DATE, "2024-01-01"),
              field(2, c.FIELD_SANCTIONED_AMOUNT, "0"), field(2, c.FIELD_SANCTIONED_DATE, "2024-09-01"),
              field(3, c.FIELD_SANCTIONED_AMOUNT, "300"), field(3, c.FIELD_SANCTIONED_DATE, "2024-05-01"),
              field(4, c.FIELD_SANCTIONED_DATE, "2024-10-01"), field(5, c.FIELD_SANCTIONED_AMOUNT, "500")]
    row = sanctioned(spark, dict.fromkeys((1, 2, 3, 4, 5), 1), fields)["C1"]
    assert (row["prev_ticket_id"], row["Sanctioned_Credit_Risk_Exposure"], row["rowno"]) == (3, "300", 1)


def test_other_groups_text_is_never_cast(spark):
    fields = [field(1, c.FIELD_SANCTIONED_AMOUNT, "100"), field(2, c.FIELD_SANCTIONED_AMOUNT, "to be agreed")]
    assert set(sanctioned(spark, {1: 1, 2: 2}, fields)) == {"C1"}
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        sanctioned(spark, {1: 1, 2: 1}, fields)


def test_sanctioned_needs_a_creditor(spark):
    fields = [field(1, c.FIELD_SANCTIONED_AMOUNT, "100")]
    assert sanctioned(spark, {1: 1}, fields, organisation=[{**ORGANISATION, "creditor_id": None}]) == {}


def test_onboarding_amount_counts_per_creditor(spark):
    organisations = [{**ORGANISATION, "created_at": days(-1), "merchant_category_code": "7995", "account_id": "A1"},
                     {"organisation_id": "O2", "creditor_id": "C9", "created_at": days(-2),
                      "merchant_category_code": "7995"},
                     {"organisation_id": "O3", "creditor_id": "C8", "created_at": days(0)},
                     {"organisation_id": "O4", "creditor_id": "C7", "created_at": days(0),
                      "merchant_category_code": "shop"}]
    tables = make_sources(
        spark, organisation=organisations,
        organisation_fact=[{"organisation_id": "O1", "total_payment_gbp_amount_in_all_time": 12.5}],
        creditor=[MERCHANT, {**MERCHANT, "id": "C2"}],
        opportunity=[{"account_id": "A1", "opportunity_id": "P1", "opportunity_created_date": on(-9)},
                     {"account_id": "A1", "opportunity_id": "P2", "opportunity_created_date": on(-3)}])
    rows = by_key(f.onboarding_amounts(tables, AS_OF, c.OnboardingParams()))
    assert set(rows) == {"C1", "C7"}
    assert rows["C1"]["payment_gbp_amount_in_all_time"] == Decimal("25.00")
    assert rows["C1"]["salesforce_opportunity_id"] == "P2"
    assert rows["C7"]["merchant_category_code"] is None
    assert rows["C7"]["payment_gbp_amount_in_all_time"] is None
    once = by_key(f.onboarding_amounts(tables, AS_OF, c.OnboardingParams(dedupe_creditors=True)))
    assert once["C1"]["payment_gbp_amount_in_all_time"] == Decimal("12.50")
