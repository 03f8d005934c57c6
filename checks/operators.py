"""Single operators against the oracle, on whole tables."""

from __future__ import annotations

from datetime import date, timedelta
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import ctes as x
from checks.binding import AS_OF, raw, scratch, sources
from checks.params import CHARGEBACK, INSOLVENCY, QUALIFIER
from checks.registry import check
from riskwatch import config as c
from riskwatch.functions import scalars as s
from riskwatch.functions import text as t
from riskwatch.operators import joins, rules
from riskwatch.operators.fingerprint import fingerprint
from riskwatch.operators.metrics import any_window, pivot_fields, titled
from riskwatch.operators.rows import latest, with_previous
from riskwatch.plans import features as f
from riskwatch.plans import merge, pipelines
from riskwatch.sources import COLUMNS, emit, log_fields, read_results, read_written, write_results

col = F.col

# --- Sources and sinks ------------------------------------------------------


@check("src1", x.query(" UNION ALL ".join(x.fingerprint(name, COLUMNS[name]) for name in COLUMNS)))
def src1(spark, sf):
    """Every logical table is scanned: a checksum of each column and of whole rows."""
    tables = sources(spark, sf)
    found = [
        fingerprint(tables.table(name).select(*COLUMNS[name])).select(F.lit(name).alias("table_name"), "*")
        for name in COLUMNS
    ]
    return reduce(DataFrame.unionByName, found)


@check("src2", x.query("""
    SELECT m.organisation_id, m.account_id, s.opportunity_id
    FROM organisation m LEFT JOIN (SELECT account_id, opportunity_id FROM opportunity
        QUALIFY row_number() OVER (PARTITION BY account_id
            ORDER BY opportunity_created_date DESC NULLS LAST, opportunity_id DESC NULLS LAST) = 1) s
    ON m.account_id = s.account_id"""))
def src2(spark, sf):
    """A reduced relation as join input."""
    tables = sources(spark, sf)
    newest = f.latest_opportunity(tables).select("account_id", "opportunity_id")
    return tables.table("organisation").select("organisation_id", "account_id").join(newest, "account_id", "left")


@check("src3", x.query("""
    SELECT creditor_id, percentile AS score, has_insolvency, CAST(CAST(retrieved_at AS DATE) AS VARCHAR) AS retrieved
    FROM score_report WHERE percentile IS NOT NULL"""))
def src3(spark, sf):
    """Nested leaves, filtered on one of them."""
    score = col("dnb_assessment.failure_score.national_percentile")
    return sources(spark, sf).table("score_report").where(score.isNotNull()).select(
        "creditor_id",
        score.alias("score"),
        col("legal_events.has_insolvency").alias("has_insolvency"),
        s.day(col("retrieved_at")).alias("retrieved"),
    )


@check("src4", x.query("""
    SELECT json_extract_string("values", '$.creditor_id') AS creditor_id,
           json_extract_string("values", '$.ticket_id') AS ticket_id,
           CAST(json_extract_string("values", '$.cb_rate_30days') AS DOUBLE) AS logged_rate,
           CAST(CAST(runtime AS DATE) AS VARCHAR) AS logged_on
    FROM result_log WHERE logtype = 'result' AND process_name = 'credit_chargeback_monitoring'"""))
def src4(spark, sf):
    """Prior results of one process from the log."""
    rows = read_results(sources(spark, sf).table("result_log"), c.PROCESS_CHARGEBACK)
    return log_fields(rows, "creditor_id", "ticket_id", "cb_rate_30days").select(
        "creditor_id",
        "ticket_id",
        s.strict_double(col("cb_rate_30days")).alias("logged_rate"),
        s.day(col("runtime")).alias("logged_on"),
    )


@check("snk1", x.query("""
    SELECT *, 'exposure_snapshot' AS process_name, false AS ActionField_FreezeAccount FROM latest_exposure""",
    "", "fds_exposure_current"))
def snk1(spark, sf):
    """All columns, the process name and an action column."""
    return emit(
        f.latest_exposure(sources(spark, sf)), "exposure_snapshot", **{c.FREEZE_ACCOUNT: F.lit(False)}
    )


def _written(name, date_text):
    return f"""SELECT creditor_id, amount_gbp AS fds_exposure_current,
        CAST({c.TicketSettings().update_ticket_id} AS BIGINT) AS ticket_id, {name} AS process_name,
        DATE '{date_text}' AS run_date FROM exposure"""


@check("snk1_written", x.query(f"""
    {_written("'Test_Oct15'", "2001-08-02")} WHERE amount_gbp > 1000
    UNION ALL {_written("'Test_Oct15'", "2001-08-03")}
    UNION ALL {_written("'again'", "2001-08-03")}""", "run_date", "fds_exposure_current"))
def snk1_written(spark, sf):
    """Through the written table: two dates, one of them run three times, two processes."""
    path, later = scratch(spark, "results"), AS_OF + timedelta(days=1)
    rows = pipelines.ticket_update(sources(spark, sf), AS_OF).drop(c.UPDATE_TICKET)
    few = rows.where(col("fds_exposure_current") > 1000)
    write_results(few, path, AS_OF, verify=True)
    write_results(few, path, later)
    write_results(rows.limit(0), path, later, process=c.PROCESS_TICKET_UPDATE)
    write_results(rows, path, later, process=c.PROCESS_TICKET_UPDATE, verify=True)
    write_results(rows.withColumn("process_name", F.lit("again")), path, later, verify=True)
    return read_written(spark, path, rows.schema)


# --- Projections ------------------------------------------------------------


@check("prj1", x.query("""
    SELECT creditor_id, organisation_id, merchant_name, geo, merchant_risk_label, merchant_risk_label_description,
           account_type, current_state, parent_account_id, parent_account_name, is_cs_managed, csm_owner_name
    FROM details"""))
def prj1(spark, sf):
    return f.creditor_details(sources(spark, sf)).select(
        "creditor_id", "organisation_id", "merchant_name", "geo", "merchant_risk_label",
        "merchant_risk_label_description", "account_type", "current_state", "parent_account_id",
        "parent_account_name", "is_cs_managed", "csm_owner_name",
    )


@check("prj2", x.query("""
    SELECT *, fds_exposure_current >= 250000 AS is_large, CAST(fds_exposure_current * 2 AS DOUBLE) AS doubled
    FROM latest_exposure""", "", "fds_exposure_current"))
def prj2(spark, sf):
    amount = col("fds_exposure_current")
    return f.latest_exposure(sources(spark, sf)).withColumns({"is_large": amount >= 250_000, "doubled": amount * 2})


@check("prj3", x.query("""
    SELECT creditor_id, CAST(1 AS BIGINT) AS var1, CAST(3417983 AS BIGINT) AS ticket_id,
           CAST(360005611314 AS BIGINT) AS group_id, 'Test_Oct15' AS process_name FROM latest_exposure"""))
def prj3(spark, sf):
    settings = c.TicketSettings()
    rows = f.latest_exposure(sources(spark, sf)).select(
        "creditor_id",
        F.lit(1).alias("var1"),
        F.lit(settings.update_ticket_id).cast("bigint").alias("ticket_id"),
        F.lit(settings.group_id).cast("bigint").alias("group_id"),
    )
    return emit(rows, c.PROCESS_TICKET_UPDATE)


@check("prj4", x.query("""
    SELECT id AS creditor_id, false AS ActionField_FreezeAccount, false AS ActionField_DisablePayouts,
           CAST(NULL AS BIGINT) AS ActionField_ChangeHoldingPeriod,
           CAST(NULL AS BIGINT) AS ActionField_ApplyNegBalanceLimits FROM creditor"""))
def prj4(spark, sf):
    ids = sources(spark, sf).table("creditor").select(col("id").alias("creditor_id"))
    return ids.withColumns(rules.stub_actions())


# --- Filters ----------------------------------------------------------------


@check("flt1", x.query("SELECT id, is_payment_provider FROM creditor WHERE NOT is_payment_provider"))
def flt1(spark, sf):
    """NULL flags are dropped with the true ones."""
    creditor = sources(spark, sf).table("creditor")
    return creditor.where(~col("is_payment_provider")).select("id", "is_payment_provider")


@check("flt2", x.query("SELECT creditor_id, current_state FROM joined WHERE current_state <> 'preactive'"))
def flt2(spark, sf):
    """A right-side predicate makes the left join an inner one."""
    details = f.creditor_details(sources(spark, sf), require_active=True, exclude_payment_providers=False)
    return details.select("creditor_id", "current_state")


@check("flt3", x.query("SELECT creditor_id, merchant_risk_label_description, insolvency_flag FROM joined"))
def flt3(spark, sf):
    details = f.creditor_details(sources(spark, sf), exclude_payment_providers=False)
    return details.select("creditor_id", "merchant_risk_label_description", "insolvency_flag")


@check("flt4", x.query(f"""
    SELECT organisation_id, code, coalesce(code IN ({x.RESTRICTED}), false) AS restricted,
           coalesce(code IN ({x.COMPLIANCE}), false) AS compliance
    FROM (SELECT organisation_id, TRY_CAST(merchant_category_code AS BIGINT) AS code FROM organisation)"""))
def flt4(spark, sf):
    code = s.safe_long(col("merchant_category_code"))
    return sources(spark, sf).table("organisation").select(
        "organisation_id",
        code.alias("code"),
        s.in_set(code, c.RESTRICTED_CODES).alias("restricted"),
        s.in_set(code, c.COMPLIANCE_CODES).alias("compliance"),
    )


@check("flt5", x.query(f"""
    SELECT creditor_id, CAST(charge_date AS DATE) AS charged, amount_gbp FROM payment
    WHERE {x.window('charge_date', 90)}""", "charged", "amount_gbp"))
def flt5(spark, sf):
    rows = sources(spark, sf).table("payment").where(s.within_days(col("charge_date"), AS_OF, -90, -1))
    return rows.select("creditor_id", s.day(col("charge_date")).alias("charged"), "amount_gbp")


@check("flt6", x.query(f"""
    SELECT creditor_id, CAST(charge_date AS DATE) AS charged, CAST(refund_created_at AS DATE) AS refunded,
           amount_gbp FROM payment WHERE {x.NARROW}""", "charged refunded", "amount_gbp"))
def flt6(spark, sf):
    rows = sources(spark, sf).table("payment").where(any_window(f.TRAILING, AS_OF))
    return rows.select(
        "creditor_id",
        s.day(col("charge_date")).alias("charged"),
        s.day(col("refund_created_at")).alias("refunded"),
        "amount_gbp",
    )


@check("flt7", x.query(f"""
    SELECT owner_id, calendar_date, balance_amount_sum_gbp FROM daily_balance
    WHERE name = 'available_merchant_funds' AND calendar_date = {x.YESTERDAY}""",
    "calendar_date", "balance_amount_sum_gbp"))
def flt7(spark, sf):
    rows = sources(spark, sf).table("daily_balance")
    pinned = (col("name") == c.BALANCE_NAME) & (col("calendar_date") == s.as_of_date(AS_OF, -1))
    return rows.where(pinned).select("owner_id", "calendar_date", "balance_amount_sum_gbp")


@check("flt8", x.query("""
    SELECT organisation_id, CAST(created_at AS DATE) AS created_on, merchant_category_code FROM organisation
    WHERE CAST(created_at AS DATE) >= DATE '2001-08-01' AND merchant_category_code IS NOT NULL""", "created_on"))
def flt8(spark, sf):
    created = s.day(col("created_at"))
    rows = sources(spark, sf).table("organisation")
    fresh = (created >= s.as_of_date(AS_OF, -1)) & col("merchant_category_code").isNotNull()
    return rows.where(fresh).select("organisation_id", created.alias("created_on"), "merchant_category_code")


@check("flt9", x.query("""
    SELECT ticket_id, next_review_date FROM review_tickets
    WHERE next_review_date IN (DATE '2001-08-02', DATE '2001-08-03', DATE '2001-08-07')""", "next_review_date"))
def flt9(spark, sf):
    due = (date(2001, 8, 2), date(2001, 8, 3), date(2001, 8, 7))
    tickets = f.ticket_review_dates(sources(spark, sf))
    return tickets.where(col("next_review_date").isin(*due)).select("ticket_id", "next_review_date")


@check("flt10", x.query(
    "SELECT creditor_id, fds_exposure_current, Sanctioned_Credit_Risk_Exposure FROM ruled_sanctioned",
    "", "fds_exposure_current"))
def flt10(spark, sf):
    tables = sources(spark, sf)
    rows = joins.star_merge(
        f.creditor_details(tables), [f.sanctioned_exposure(tables), f.latest_exposure(tables)], "creditor_id"
    ).select(
        "creditor_id",
        "insolvency_flag",
        merge.rounded("fds_exposure_current"),
        s.strict_double(col("Sanctioned_Credit_Risk_Exposure")).alias("Sanctioned_Credit_Risk_Exposure"),
    )
    return rows.where(rules.exceeds_sanctioned(c.SanctionedExposureParams())).drop("insolvency_flag")


@check("flt11", x.query("""
    SELECT creditor_id, chargeback_monitoring_alert FROM ruled_chargeback
    WHERE chargeback_monitoring_alert IN ('New Alert', 'Chargeback Rate Increase >10% since last trigger',
          'Chargeback Rate Re-Trigger after 90 days')"""))
def flt11(spark, sf):
    """Membership of a computed label."""
    params = c.ChargebackParams(min_peer_chargebacks=600, require_qualifier=False)
    rows = pipelines.chargeback(sources(spark, sf), AS_OF, params)
    return rows.select("creditor_id", "chargeback_monitoring_alert")


@check("flt12", x.query("""
    SELECT creditor_id, most_recent_risk_label_created_at, fds_exposure_current,
           merchant_payment_amt_gbp_last_365d FROM ruled_insolvency""",
    "most_recent_risk_label_created_at", "fds_exposure_current merchant_payment_amt_gbp_last_365d"))
def flt12(spark, sf):
    """Label-date floor, ``is true`` and either materiality limit."""
    return pipelines.insolvency(sources(spark, sf), AS_OF, INSOLVENCY).select(
        "creditor_id", "most_recent_risk_label_created_at", "fds_exposure_current",
        "merchant_payment_amt_gbp_last_365d",
    )


@check("flt13", x.query("""
    SELECT creditor_id, nb_balance_current, nb_balance_prev, nb_alert_type FROM ruled_negative_balance
    WHERE creditor_id = 'CR37'""", "", "nb_balance_current"))
def flt13(spark, sf):
    """A process pinned to a creditor."""
    params = c.NegativeBalanceParams(creditor_ids=("CR37",))
    return pipelines.negative_balance(sources(spark, sf), AS_OF, params).select(
        "creditor_id", "nb_balance_current", "nb_balance_prev", "nb_alert_type"
    )


# --- Rule columns -----------------------------------------------------------


@check("rul1", x.query(f"""
    SELECT creditor_id, db_failure_score_last_date, CAST({x.MATERIAL} AS BIGINT) AS qualifies FROM merged_score_drop""",
    "db_failure_score_last_date"))
def rul1(spark, sf):
    rows = merge.score_drop(sources(spark, sf), AS_OF)
    return rows.select("creditor_id", "db_failure_score_last_date", rules.qualifies(QUALIFIER).alias("qualifies"))


@check("rul2", x.query("""
    SELECT creditor_id, db_failure_score_current, db_failure_score_change, failure_score_monitoring_alert
    FROM ruled_score_drop"""))
def rul2(spark, sf):
    return merge.score_drop(sources(spark, sf), AS_OF).select(
        "creditor_id",
        "db_failure_score_current",
        "db_failure_score_change",
        rules.score_drop_alert(c.SCORE_DROP_BANDS).alias("failure_score_monitoring_alert"),
    )


@check("rul3", x.query("""
    SELECT creditor_id, cb_rate_30days, reference_cb_rate, chargeback_monitoring_rate_last,
           chargeback_monitoring_days_since, chargeback_monitoring_alert FROM ruled_chargeback"""))
def rul3(spark, sf):
    return merge.chargeback(sources(spark, sf), AS_OF, CHARGEBACK).select(
        "creditor_id", "cb_rate_30days", "reference_cb_rate", "chargeback_monitoring_rate_last",
        "chargeback_monitoring_days_since",
        rules.chargeback_alert(CHARGEBACK).alias("chargeback_monitoring_alert"),
    )


@check("rul4", x.query("""
    SELECT creditor_id, nb_balance_current, nb_balance_prev, neg_bal_monitoring_days_since, nb_alert_type
    FROM ruled_negative_balance""", "", "nb_balance_current"))
def rul4(spark, sf):
    return merge.negative_balance(sources(spark, sf), AS_OF).select(
        "creditor_id", "nb_balance_current", "nb_balance_prev", "neg_bal_monitoring_days_since",
        rules.negative_balance_alert(c.NegativeBalanceParams()).alias("nb_alert_type"),
    )


@check("rul5", x.query("""
    SELECT creditor_id, merchant_name, restricted_industry, compliance_hrob, freeze_account_action,
           create_zendesk_ticket FROM onboarding_decided"""))
def rul5(spark, sf):
    params = c.OnboardingParams()
    rows = f.onboarding_amounts(sources(spark, sf), AS_OF, params)
    decisions = [v.alias(k) for k, v in rules.onboarding_decisions(params).items()]
    return rows.select("creditor_id", "merchant_name", *decisions)


@check("rul6", """
    SELECT c_custkey, CAST(CASE WHEN CAST(c_acctbal AS DECIMAL(18,2)) < 0
        THEN CAST(c_acctbal AS DECIMAL(18,2)) ELSE 0 END AS DOUBLE) AS clamped FROM customer""")
def rul6(spark, sf):
    amount = s.money(col("c_acctbal"))
    return raw(spark, sf, "customer").select("c_custkey", s.negative_part(amount).alias("clamped"))


@check("rul7", x.query("""
    SELECT merchant_category_code, CASE WHEN mcc_chargeback_vol_last_12m >= 600
        THEN mcc_chargeback_rate_vol_last_12m ELSE portfolio_chargeback_rate_vol_last_12m END AS reference_cb_rate
    FROM (SELECT *, 1 AS one FROM categories) LEFT JOIN portfolio ON one = var1"""))
def rul7(spark, sf):
    tables = sources(spark, sf)
    _, categories = f.peer_totals(tables, AS_OF)
    rows = joins.attach_one_row(categories.withColumn("var1", F.lit(1)), f.portfolio_totals(categories), "var1")
    return rows.select("merchant_category_code", rules.reference_rate(600).alias("reference_cb_rate"))


@check("rul8", x.query("""
    SELECT organisation_id, CASE WHEN is_cs_managed_salesforce IS TRUE
        OR parent_account_stage IN ('CS Managed - Ent&MM', 'CS Managed - SB') THEN 'Yes' ELSE 'No' END AS managed
    FROM organisation"""))
def rul8(spark, sf):
    label = rules.managed_label(col("is_cs_managed_salesforce"), col("parent_account_stage"))
    return sources(spark, sf).table("organisation").select("organisation_id", label.alias("managed"))


# --- Joins ------------------------------------------------------------------


@check("jon1", x.query("SELECT creditor_id, organisation_id, current_state, parent_account_id FROM joined"))
def jon1(spark, sf):
    """Creditors keep their row without an organisation."""
    details = f.creditor_details(sources(spark, sf), exclude_payment_providers=False)
    return details.select("creditor_id", "organisation_id", "current_state", "parent_account_id")


@check("jon2", x.query("""
    SELECT a.creditor_id, b.fds_exposure_current, c.db_failure_score_current, e.balance_amount_sum_gbp,
           f.cb_rate_90days, d.prediction_date
    FROM details a
    LEFT JOIN latest_exposure b ON a.creditor_id = b.creditor_id
    LEFT JOIN latest_failure_score c ON a.creditor_id = c.creditor_id
    LEFT JOIN latest_default_probability d ON a.creditor_id = d.creditor_id
    LEFT JOIN yesterday_balance e ON a.creditor_id = e.creditor_id
    LEFT JOIN payment_rates f ON a.creditor_id = f.creditor_id""",
    "", "fds_exposure_current balance_amount_sum_gbp"))
def jon2(spark, sf):
    tables = sources(spark, sf)
    merged = joins.star_merge(
        f.creditor_details(tables),
        [
            f.latest_exposure(tables),
            f.latest_failure_score(tables),
            f.latest_default_probability(tables),
            f.yesterday_balance(tables, AS_OF),
            f.payment_rates(f.payment_window_metrics(tables, AS_OF)),
        ],
        "creditor_id",
    )
    return merged.select(
        "creditor_id", "fds_exposure_current", "db_failure_score_current", "balance_amount_sum_gbp",
        "cb_rate_90days", "prediction_date",
    )


@check("jon3", x.query("""
    SELECT a.creditor_id, a.merchant_category_code, f.mcc_payment_vol_last_12m, f.mcc_chargeback_rate_vol_last_12m
    FROM details a LEFT JOIN categories f ON a.merchant_category_code = f.merchant_category_code"""))
def jon3(spark, sf):
    """Peer lookup with few, hot keys; a NULL code matches nothing."""
    tables = sources(spark, sf)
    _, categories = f.peer_totals(tables, AS_OF)
    rows = joins.spread_lookup(f.creditor_details(tables), categories, "merchant_category_code", "creditor_id")
    return rows.select(
        "creditor_id", "merchant_category_code", "mcc_payment_vol_last_12m", "mcc_chargeback_rate_vol_last_12m"
    )


@check("jon4", x.query("""
    SELECT a.creditor_id, g.portfolio_payment_vol_last_12m, g.portfolio_chargeback_rate_vol_last_12m
    FROM details a LEFT JOIN portfolio g ON a.var1 = g.var1"""))
def jon4(spark, sf):
    tables = sources(spark, sf)
    totals = f.portfolio_totals(f.peer_totals(tables, AS_OF)[1])
    rows = joins.attach_one_row(f.creditor_details(tables), totals, "var1")
    return rows.select("creditor_id", "portfolio_payment_vol_last_12m", "portfolio_chargeback_rate_vol_last_12m")


@check("jon5", x.query("""
    SELECT a.creditor_id, b.merchant_category_code, count(*) AS payments FROM payment a
    LEFT JOIN creditor b ON a.creditor_id = b.id WHERE NOT b.is_payment_provider GROUP BY 1, 2"""))
def jon5(spark, sf):
    """Facts are aggregated first, then joined to the filtered dimension."""
    tables = sources(spark, sf)
    creditor = tables.table("creditor").where(~col("is_payment_provider")).select(
        col("id").alias("creditor_id"), "merchant_category_code"
    )
    counted = tables.table("payment").groupBy("creditor_id").agg(F.count(F.lit(1)).alias("payments"))
    return counted.join(creditor, "creditor_id")


@check("jon6", x.query("""
    SELECT creditor_id, prev_ticket_id, created_at, Sanctioned_Credit_Risk_Exposure FROM sanctioned_tickets""",
    "created_at"))
def jon6(spark, sf):
    """Tickets, fields, groups, ticket organisations and merchants."""
    return f.sanctioned_exposure(sources(spark, sf)).select(
        "creditor_id", "prev_ticket_id", "created_at", "Sanctioned_Credit_Risk_Exposure"
    )


@check("jon7", x.query("SELECT ticket_id, created_at, organisation_id, reason_for_next_review FROM review_tickets",
                       "created_at"))
def jon7(spark, sf):
    """Tickets, fields and ticket organisations."""
    return f.ticket_review_dates(sources(spark, sf)).select(
        "ticket_id", "created_at", "organisation_id", "reason_for_next_review"
    )


@check("jon8", x.query("""
    SELECT a.creditor_id, g.ticket_id, g.next_review_date
    FROM details a LEFT JOIN review_tickets g ON a.organisation_id = g.organisation_id""", "next_review_date"))
def jon8(spark, sf):
    """One row per creditor and ticket of its organisation."""
    tables = sources(spark, sf)
    rows = joins.many_to_many(
        f.creditor_details(tables), f.ticket_review_dates(tables), "organisation_id", "creditor_id", "ticket_id"
    )
    return rows.select("creditor_id", "ticket_id", "next_review_date")


@check("jon8_cells", x.query("""
    SELECT id AS creditor_id, payment.creditor_id AS payer, amount_gbp
    FROM creditor JOIN payment ON creditor.geo = CASE WHEN amount_gbp > 95000 THEN 'G1' WHEN amount_gbp > 94000 THEN 'G2' END""",
    "", "amount_gbp"))
def jon8_cells(spark, sf):
    """Keys hot on both sides, cut into cells; amounts are brought to their form once a payment,
    and creditors meet them in packs, so that files of all pairs stay small."""
    tables, amount = sources(spark, sf), col("amount_gbp")
    left = tables.table("creditor").select(col("id").alias("creditor_id"), "geo")
    place = F.when(amount > 95_000, "G1").when(amount > 94_000, "G2")
    right = tables.table("payment").select(
        col("creditor_id").alias("payer"),
        s.money(amount).cast("double").alias("amount_gbp"),
        place.alias("geo"),
    )
    rows = joins.many_to_many(
        joins.packed(left, "geo", "creditor_id"),
        joins.told_apart(right, "_row_hash"),
        "geo", "_pack", "_row_hash", "inner",
        cell=16, most=64, held=joins.MET_ROWS, tasks=int(spark.conf.get("spark.sql.shuffle.partitions")),
    )
    return rows.select(F.inline("_packed"), "payer", "amount_gbp")


@check("jon9", x.query("""
    SELECT creditor_id, merchant_name, salesforce_opportunity_id, merchant_category_code, created_date,
           payment_gbp_amount_in_all_time FROM onboarding""", "created_date", "payment_gbp_amount_in_all_time"))
def jon9(spark, sf):
    """Onboarding join; the amount counts once per creditor."""
    rows = f.onboarding_amounts(sources(spark, sf), AS_OF, c.OnboardingParams())
    return rows.drop("merchant_geo")


# --- Aggregates -------------------------------------------------------------


@check("agg1", x.query("""
    SELECT creditor_id, merchant_payment_vol_last_30d, merchant_chargeback_vol_last_30d,
           merchant_payment_vol_last_90d, merchant_chargeback_vol_last_90d, merchant_failure_vol_last_90d,
           merchant_late_failure_vol_last_90d, merchant_refund_vol_last_90d FROM payment_metrics"""))
def agg1(spark, sf):
    """Conditional counts over trailing windows in one aggregate."""
    counts = [m for m in f.TRAILING if m.amount is None]
    rows = sources(spark, sf).table("payment").where(any_window(f.TRAILING, AS_OF))
    return rows.groupBy("creditor_id").agg(*[m.column(AS_OF) for m in counts])


@check("agg2", x.query(
    "SELECT creditor_id, merchant_payment_amt_gbp_last_365d, future_payments_7days FROM payment_metrics",
    "", "merchant_payment_amt_gbp_last_365d future_payments_7days"))
def agg2(spark, sf):
    """Conditional amounts, trailing and ahead."""
    rows = sources(spark, sf).table("payment").where(any_window(f.TRAILING, AS_OF))
    return rows.groupBy("creditor_id").agg(f.PAID_LAST_YEAR.column(AS_OF), f.NEXT_WEEK.column(AS_OF))


@check("agg3", x.query("""
    SELECT owner_id, calendar_date, sum(balance_amount_sum_gbp) AS balance FROM daily_balance
    WHERE name = 'available_merchant_funds' GROUP BY 1, 2""", "calendar_date", "balance"))
def agg3(spark, sf):
    """Balance per owner and day, over all days."""
    rows = sources(spark, sf).table("daily_balance").where(col("name") == c.BALANCE_NAME)
    return rows.groupBy("owner_id", "calendar_date").agg(
        F.sum(s.money(col("balance_amount_sum_gbp"))).alias("balance")
    )


@check("agg4", x.query("SELECT * FROM categories", "", "mcc_payment_amt_last_12m mcc_chargeback_amt_last_12m"))
def agg4(spark, sf):
    tables = sources(spark, sf)
    return f.peer_totals(tables, AS_OF)[1]


@check("agg5", x.query(
    "SELECT * FROM portfolio", "", "portfolio_payment_amt_last_12m portfolio_chargeback_amt_last_12m"))
def agg5(spark, sf):
    tables = sources(spark, sf)
    return f.portfolio_totals(f.peer_totals(tables, AS_OF)[1])


@check("agg6", x.query("""
    SELECT ticket_id, max(CASE WHEN ticket_field_title = 'Next Review Date'
            AND regexp_full_match(ticket_field_value, '\\s*\\d{4}-\\d{1,2}-\\d{1,2}\\s*')
            THEN TRY_CAST(ticket_field_value AS DATE) END) AS next_review_date,
           max(CASE WHEN ticket_field_title = 'Reason for next review' THEN ticket_field_value END) AS reason
    FROM ticket_field WHERE ticket_field_title IN ('Next Review Date', 'Reason for next review')
    GROUP BY 1""", "next_review_date"))
def agg6(spark, sf):
    """Field pivot with a safe date."""
    title, value = "ticket_field_title", col("ticket_field_value")
    return pivot_fields(sources(spark, sf).table("ticket_field"), "ticket_id", title, {
        c.FIELD_NEXT_REVIEW: F.max(titled(title, c.FIELD_NEXT_REVIEW, s.safe_date(value))).alias("next_review_date"),
        c.FIELD_REVIEW_REASON: F.max(titled(title, c.FIELD_REVIEW_REASON, value)).alias("reason"),
    })


@check("agg7", x.query("""
    SELECT ticket_id,
           max(CASE WHEN ticket_field_title = 'Sanctioned Credit Risk Exposure' THEN ticket_field_value END) AS amount,
           min(CASE WHEN ticket_field_title = 'Sanctioned Date' THEN ticket_field_value END) AS dated
    FROM ticket_field WHERE ticket_field_title IN ('Sanctioned Credit Risk Exposure', 'Sanctioned Date')
    GROUP BY 1"""))
def agg7(spark, sf):
    """Field pivot on text: largest and smallest compare as text."""
    title, value = "ticket_field_title", col("ticket_field_value")
    return pivot_fields(sources(spark, sf).table("ticket_field"), "ticket_id", title, {
        c.FIELD_SANCTIONED_AMOUNT: F.max(titled(title, c.FIELD_SANCTIONED_AMOUNT, value)).alias("amount"),
        c.FIELD_SANCTIONED_DATE: F.min(titled(title, c.FIELD_SANCTIONED_DATE, value)).alias("dated"),
    })


@check("agg8", x.query("SELECT creditor_id, prev_ticket_id, Sanctioned_Credit_Risk_Exposure FROM sanctioned_tickets"))
def agg8(spark, sf):
    """Filter on an aggregate by its name."""
    return f.sanctioned_exposure(sources(spark, sf)).select(
        "creditor_id", "prev_ticket_id", "Sanctioned_Credit_Risk_Exposure")


@check("agg9", x.query("SELECT creditor_id, last_payment_days_ago, newest_payment_days_ago FROM payment_metrics"))
def agg9(spark, sf):
    """Age of the oldest (as specified) and of the newest charge."""
    age = s.days_since(AS_OF, s.day(col("charge_date")))
    rows = sources(spark, sf).table("payment").where(any_window(f.TRAILING, AS_OF))
    return rows.groupBy("creditor_id").agg(
        F.max(age).alias("last_payment_days_ago"), F.min(age).alias("newest_payment_days_ago")
    )


@check("agg10", x.query("SELECT * FROM onboarding", "created_date", "payment_gbp_amount_in_all_time"))
def agg10(spark, sf):
    """Six keys, all-time amount."""
    return f.onboarding_amounts(sources(spark, sf), AS_OF, c.OnboardingParams())


@check("agg11", x.query("""
    SELECT 'balance' AS grouping, creditor_id || '/' || calendar_date AS keys,
           CAST(balance_amount_sum_gbp AS DOUBLE) AS total FROM yesterday_balance
    UNION ALL SELECT 'payments', creditor_id, CAST(merchant_payment_vol_last_90d AS DOUBLE) FROM payment_metrics
    UNION ALL SELECT 'category', merchant_category_code, CAST(mcc_payment_amt_last_12m AS DOUBLE) FROM categories
    UNION ALL SELECT 'portfolio', CAST(var1 AS VARCHAR), CAST(portfolio_payment_amt_last_12m AS DOUBLE) FROM portfolio
    UNION ALL SELECT 'onboarding', concat_ws('/', creditor_id, merchant_name, merchant_geo, salesforce_opportunity_id,
        merchant_category_code, created_date), CAST(payment_gbp_amount_in_all_time AS DOUBLE) FROM onboarding"""))
def agg11(spark, sf):
    """Grouping keys by position are explicit keys: all groupings of the features."""
    tables = sources(spark, sf)
    _, categories = f.peer_totals(tables, AS_OF)

    def keyed(name, rows, keys, total):
        return rows.select(F.lit(name).alias("grouping"), F.concat_ws("/", *keys).alias("keys") if len(keys) > 1
                           else col(keys[0]).cast("string").alias("keys"), col(total).cast("double").alias("total"))

    onboarding = f.onboarding_amounts(tables, AS_OF, c.OnboardingParams())
    return reduce(DataFrame.unionByName, [
        keyed("balance", f.yesterday_balance(tables, AS_OF), ["creditor_id", "calendar_date"], "balance_amount_sum_gbp"),
        keyed("payments", f.payment_window_metrics(tables, AS_OF), ["creditor_id"], "merchant_payment_vol_last_90d"),
        keyed("category", categories, ["merchant_category_code"], "mcc_payment_amt_last_12m"),
        keyed("portfolio", f.portfolio_totals(categories), ["var1"], "portfolio_payment_amt_last_12m"),
        keyed("onboarding", onboarding, onboarding.columns[:6], "payment_gbp_amount_in_all_time"),
    ])


# --- Windows ----------------------------------------------------------------


@check("win1", """
    SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (
        PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC) = 1""")
def win1(spark, sf):
    rows = raw(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    return latest(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@check("win2", """
    SELECT user_id, event_id, value, row_number() OVER (
        PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC) AS rowno
    FROM events QUALIFY rowno = 1""")
def win2(spark, sf):
    rows = raw(spark, sf, "events").select("user_id", "event_id", "value", "ts")
    return latest(rows, ["user_id"], ["ts", "event_id"], keep_number=True).drop("ts")


@check("win3", """
    SELECT json_extract_string(props, '$.k') AS k, event_type, event_id FROM events
    QUALIFY row_number() OVER (PARTITION BY json_extract_string(props, '$.k'), event_type
        ORDER BY ts DESC NULLS LAST, event_id DESC) = 1""")
def win3(spark, sf):
    """Newest per JSON key and process."""
    rows = raw(spark, sf, "events").select(
        s.json_value(col("props"), "k").alias("k"), "event_type", "event_id", "ts"
    )
    return latest(rows, ["k", "event_type"], ["ts", "event_id"]).drop("ts")


@check("win4", x.query("SELECT * FROM sanctioned_tickets", "created_at"))
def win4(spark, sf):
    """Ordered by an aggregate, after the filter on aggregates."""
    return f.sanctioned_exposure(sources(spark, sf))


@check("win5", """
    SELECT event_id, user_id, value, coalesce(lag(value) OVER w, value) AS value_last,
           CAST(coalesce(lag(CAST(ts AS DATE)) OVER w, CAST(ts AS DATE)) AS VARCHAR) AS date_last
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts ASC NULLS FIRST, event_id ASC)""")
def win5(spark, sf):
    """Previous value over the whole history, the own one for the first row."""
    rows = raw(spark, sf, "events").select("event_id", "user_id", "value", s.day(col("ts")).alias("on"), "ts")
    stepped = with_previous(
        rows, "user_id", ["ts", "event_id"], {"value_last": "value", "date_last": "on"},
        bucket=F.date_trunc("day", col("ts")),
    )
    return stepped.drop("ts", "on")


@check("win6", x.query("""
    SELECT creditor_id, db_failure_score_current, db_failure_score_last, db_failure_score_change
    FROM score_change"""))
def win6(spark, sf):
    """Change against the report before, on yesterday's reports only."""
    return f.failure_score_change(sources(spark, sf), AS_OF).select(
        "creditor_id", "db_failure_score_current", "db_failure_score_last", "db_failure_score_change"
    )


# --- Limit ------------------------------------------------------------------


@check("lim1", x.query("""
    SELECT creditor_id, fds_exposure_current, merchant_payment_amt_gbp_last_365d FROM ruled_insolvency
    ORDER BY creditor_id LIMIT 1""", "", "fds_exposure_current merchant_payment_amt_gbp_last_365d"))
def lim1(spark, sf):
    """The dry-run limit, made deterministic by a total order."""
    params = c.InsolvencyParams(label_since=date(2000, 6, 1), limit=1)
    return pipelines.insolvency(sources(spark, sf), AS_OF, params).select(
        "creditor_id", "fds_exposure_current", "merchant_payment_amt_gbp_last_365d"
    )


# --- Scalars ----------------------------------------------------------------


@check("sca1", """
    SELECT l_orderkey, l_linenumber, l_extendedprice / nullif(l_discount, 0) AS by_discount,
           CAST(l_linenumber AS DOUBLE) / nullif(l_linenumber - 1, 0) AS by_count FROM lineitem""")
def sca1(spark, sf):
    return raw(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        s.safe_divide(col("l_extendedprice"), col("l_discount")).alias("by_discount"),
        s.safe_divide(col("l_linenumber"), col("l_linenumber") - 1).alias("by_count"),
    )


@check("sca2", """
    SELECT o_orderkey, -o_totalprice - (-1000.5e0) AS difference,
           CASE WHEN o_orderkey > 0 THEN NULL ELSE 9223372036854775807 - o_orderkey END AS overflowing
    FROM orders""")
def sca2(spark, sf):
    top = F.lit(9223372036854775807)
    return raw(spark, sf, "orders").select(
        "o_orderkey",
        s.safe_subtract(-col("o_totalprice"), F.lit(-1000.5)).alias("difference"),
        s.safe_subtract(top, -col("o_orderkey")).alias("overflowing"),
    )


@check("sca3", x.query("""
    SELECT ticket_id, ticket_field_value, TRY_CAST(ticket_field_value AS BIGINT) AS as_integer,
           CASE WHEN regexp_full_match(ticket_field_value, '\\s*\\d{4}-\\d{1,2}-\\d{1,2}\\s*')
                THEN CAST(TRY_CAST(ticket_field_value AS DATE) AS VARCHAR) END AS as_day FROM ticket_field"""))
def sca3(spark, sf):
    value = col("ticket_field_value")
    return sources(spark, sf).table("ticket_field").select(
        "ticket_id", "ticket_field_value", s.safe_long(value).alias("as_integer"), s.safe_date(value).alias("as_day")
    )


@check("sca4", x.query("""
    SELECT ticket_id, CAST(ticket_field_value AS DOUBLE) AS amount FROM ticket_field
    WHERE ticket_field_title = 'Sanctioned Credit Risk Exposure'"""))
def sca4(spark, sf):
    rows = sources(spark, sf).table("ticket_field").where(col("ticket_field_title") == c.FIELD_SANCTIONED_AMOUNT)
    return rows.select("ticket_id", s.strict_double(col("ticket_field_value")).alias("amount"))


@check("sca5", x.query("SELECT creditor_id, nb_alert_type FROM ruled_negative_balance"))
def sca5(spark, sf):
    """First match wins; an unknown condition does not match."""
    rows = merge.negative_balance(sources(spark, sf), AS_OF)
    alert = rules.negative_balance_alert(c.NegativeBalanceParams())
    return rows.select("creditor_id", alert.alias("nb_alert_type"))


@check("sca6", x.query("""
    SELECT creditor_id, coalesce(CAST(is_cs_managed AS VARCHAR), 'N/A') AS managed,
           coalesce(is_payment_provider, false) AS provider, coalesce(csm_owner_name, '') AS manager FROM joined"""))
def sca6(spark, sf):
    return f.creditor_details(sources(spark, sf), exclude_payment_providers=False).select(
        "creditor_id",
        t.or_missing(t.plain(col("is_cs_managed"))).alias("managed"),
        F.coalesce(col("is_payment_provider"), F.lit(False)).alias("provider"),
        t.or_missing(col("csm_owner_name"), "").alias("manager"),
    )


@check("sca7", x.query(
    "SELECT creditor_id, merchant_name || ' / ' || parent_account_name || ' / ' || csm_owner_name AS line FROM joined"))
def sca7(spark, sf):
    """One NULL part makes the whole NULL."""
    return f.creditor_details(sources(spark, sf), exclude_payment_providers=False).select(
        "creditor_id",
        t.joined(col("merchant_name"), " / ", col("parent_account_name"), " / ", col("csm_owner_name")).alias("line"),
    )


@check("sca8", f"""
    SELECT o_orderkey, 'amount ' || {x.trimmed('o_totalprice * 100')} || ' on ' || CAST(CAST(o_orderdate AS DATE) AS VARCHAR)
        || ' open ' || CAST(o_orderstatus = 'O' AS VARCHAR) || ' key ' || CAST(o_orderkey AS VARCHAR) AS line
    FROM orders""")
def sca8(spark, sf):
    """Numbers, dates and booleans inside text; no exponents."""
    return raw(spark, sf, "orders").select(
        "o_orderkey",
        t.joined(
            "amount ", t.number(F.round(col("o_totalprice") * 100, 2)),
            " on ", t.plain(s.day(col("o_orderdate"))),
            " open ", t.plain(col("o_orderstatus") == "O"),
            " key ", t.plain(col("o_orderkey")),
        ).alias("line"),
    )


@check("sca9", x.query("""
    SELECT creditor_id, prediction_date, CAST(substr(prediction_date, 1, 4) || '-' || substr(prediction_date, 5, 2)
        || '-' || substr(prediction_date, 7, 2) AS DATE) AS calendar_date FROM default_prediction""", "calendar_date"))
def sca9(spark, sf):
    return sources(spark, sf).table("default_prediction").select(
        "creditor_id", "prediction_date", s.compact_date(col("prediction_date")).alias("calendar_date")
    )


@check("sca10", f"""
    SELECT o_orderkey, CAST(o_orderdate AS DATE) = {x.AS_OF} - 1 AS is_yesterday,
           CAST(o_orderdate AS DATE) > {x.AS_OF} - 365 AS within_year,
           CAST({x.AS_OF} + 7 AS VARCHAR) AS next_week FROM orders""")
def sca10(spark, sf):
    """The run date is an argument, never the clock."""
    ordered = s.day(col("o_orderdate"))
    return raw(spark, sf, "orders").select(
        "o_orderkey",
        (ordered == s.as_of_date(AS_OF, -1)).alias("is_yesterday"),
        (ordered > s.as_of_date(AS_OF, -365)).alias("within_year"),
        s.as_of_date(AS_OF, 7).alias("next_week"),
    )


@check("sca11", "SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS on_day FROM events")
def sca11(spark, sf):
    return raw(spark, sf, "events").select("event_id", s.day(col("ts")).alias("on_day"))


@check("sca12", f"""
    SELECT l_orderkey, l_linenumber, date_diff('day', CAST(l_shipdate AS DATE), {x.AS_OF}) AS age FROM lineitem""")
def sca12(spark, sf):
    age = s.days_since(AS_OF, s.day(col("l_shipdate")))
    return raw(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", age.alias("age"))


@check("sca13", """
    SELECT o_orderkey, CAST(o_orderdate AS DATE) = DATE '2001-08-02' - 1 AS yesterday,
           CAST(o_orderdate AS DATE) > DATE '2001-08-02' - 31 AS recent FROM orders""")
def sca13(spark, sf):
    """Days before the run date."""
    ordered = s.day(col("o_orderdate"))
    return raw(spark, sf, "orders").select(
        "o_orderkey", (ordered == s.as_of_date(AS_OF, -1)).alias("yesterday"),
        (ordered > s.as_of_date(AS_OF, -31)).alias("recent"))


@check("sca14", """
    SELECT o_orderkey, CAST(round(CAST(o_totalprice AS DECIMAL(18,2)), 1) AS DOUBLE) AS up,
           CAST(round(-CAST(o_totalprice AS DECIMAL(18,2)), 1) AS DOUBLE) AS down FROM orders""")
def sca14(spark, sf):
    """Half away from zero on both sides."""
    amount = s.money(col("o_totalprice"))
    return raw(spark, sf, "orders").select(
        "o_orderkey", F.round(amount, 1).alias("up"), F.round(-amount, 1).alias("down")
    )


@check("sca15", f"""
    SELECT l_orderkey, l_linenumber, {x.grouped('CAST(l_extendedprice AS DECIMAL(18,2)) - 50000', 1)} AS one_digit,
           {x.grouped('l_extendedprice * 10000', 2)} AS two_digits, {x.grouped('l_discount * 100', 2)} AS share,
           {x.padded('CAST(l_extendedprice AS DECIMAL(18,2)) - 50000', 1)} AS one_digit_padded,
           {x.padded('l_extendedprice * 10000', 2)} AS two_digits_padded,
           {x.padded('l_discount * 100', 2)} AS share_padded
    FROM lineitem""")
def sca15(spark, sf):
    """Thousands separators, sign and fixed digits: trimmed, and as the format says."""
    amounts = {"one_digit": (s.money(col("l_extendedprice")) - 50_000, t.ONE_DECIMAL),
               "two_digits": (col("l_extendedprice") * 10_000, t.TWO_DECIMALS)}
    return raw(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        *[t.formatted(value, form).alias(name) for name, (value, form) in amounts.items()],
        t.percent(col("l_discount")).alias("share"),
        *[t.formatted(value, form, t.PADDED).alias(f"{name}_padded") for name, (value, form) in amounts.items()],
        t.percent(col("l_discount"), style=t.PADDED).alias("share_padded"),
    )


@check("sca16", """
    SELECT event_id, json_extract_string(props, '$.k') AS k, json_extract_string(props, '$.absent') AS absent,
           CAST(NULL AS VARCHAR) AS malformed,
           CASE event_id % 4 WHEN 2 THEN 'x' || event_id WHEN 3 THEN CAST(event_id AS VARCHAR) END AS scalar
    FROM events""")
def sca16(spark, sf):
    """Scalars of a document; absent, malformed, objects and arrays give NULL."""
    document = F.expr("""CASE event_id % 4 WHEN 0 THEN concat('{"v":{"a":', event_id, '}}')
        WHEN 1 THEN concat('{"v":[', event_id, ']}') WHEN 2 THEN concat('{"v":"x', event_id, '"}')
        ELSE concat('{"v":', event_id, '}') END""")
    return raw(spark, sf, "events").select(
        "event_id",
        s.json_value(col("props"), "k").alias("k"),
        s.json_value(col("props"), "absent").alias("absent"),
        s.json_value(col("event_type"), "k").alias("malformed"),
        s.json_value(document, "v").alias("scalar"),
    )


@check("sca17", x.query("SELECT creditor_id, percentile AS score, has_insolvency FROM score_report"))
def sca17(spark, sf):
    return sources(spark, sf).table("score_report").select(
        "creditor_id",
        col("dnb_assessment.failure_score.national_percentile").alias("score"),
        col("legal_events.has_insolvency").alias("has_insolvency"),
    )


@check("sca18", """
    SELECT o_orderkey,
           CAST(to_json({'key': o_orderkey, 'entries': [{'id': CAST(28480929 AS BIGINT), 'value': 'tag'}]}) AS VARCHAR)
               AS filled,
           CAST(to_json({'key': o_orderkey, 'entries': CAST([] AS STRUCT(id BIGINT, value VARCHAR)[])}) AS VARCHAR)
               AS empty FROM orders""")
def sca18(spark, sf):
    """Structs and typed lists, also empty ones."""
    key = col("o_orderkey").alias("key")
    filled = F.struct(key, s.ticket_fields((28480929, "tag")).alias("entries"))
    empty = F.struct(key, s.ticket_fields().alias("entries"))
    return raw(spark, sf, "orders").select(
        "o_orderkey", s.to_json_text(filled).alias("filled"), s.to_json_text(empty).alias("empty")
    )


@check("sca19", x.query("""
    SELECT creditor_id, CAST(to_json({'name': parent_account_name, 'managed': is_cs_managed, 'note': 'a
"b" £’'}) AS VARCHAR) AS document FROM joined"""))
def sca19(spark, sf):
    """NULL fields stay; quotes, newlines and non-ASCII are kept."""
    document = F.struct(
        col("parent_account_name").alias("name"),
        col("is_cs_managed").alias("managed"),
        F.lit('a\n"b" £’').alias("note"),
    )
    details = f.creditor_details(sources(spark, sf), exclude_payment_providers=False)
    return details.select("creditor_id", s.to_json_text(document).alias("document"))


@check("sca20", x.query("""
    SELECT creditor_id, is_cs_managed IS NULL AS unknown, is_cs_managed IS NOT NULL AS known,
           is_cs_managed IS TRUE AS yes, is_cs_managed = false AS no FROM joined"""))
def sca20(spark, sf):
    flag = col("is_cs_managed")
    return f.creditor_details(sources(spark, sf), exclude_payment_providers=False).select(
        "creditor_id", flag.isNull().alias("unknown"), flag.isNotNull().alias("known"),
        s.is_true(flag).alias("yes"), (~flag).alias("no"),
    )


@check("sca21", x.query("""
    SELECT organisation_id, if(coalesce(is_cs_managed_salesforce, false), 'Yes', 'No') AS service FROM organisation"""))
def sca21(spark, sf):
    """A NULL boolean goes to the other branch."""
    service = rules.managed_label(col("is_cs_managed_salesforce"), F.lit("Self Serve"))
    return sources(spark, sf).table("organisation").select("organisation_id", service.alias("service"))
