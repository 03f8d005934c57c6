"""Features: each brings one source to the grain the merge needs."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskwatch import config as c
from riskwatch.functions import scalars as s
from riskwatch.operators.joins import attach_one_row, spread_lookup
from riskwatch.operators.metrics import Metric, any_window, pivot_fields, titled
from riskwatch.operators.rows import latest, with_previous
from riskwatch.operators.rules import managed_label, reference_rate
from riskwatch.operators.staging import shared_folder, stage
from riskwatch.sources.payment_events import payments_let_in
from riskwatch.sources.result_log import log_fields, read_results
from riskwatch.sources.tables import Sources

# --- Merchants --------------------------------------------------------------


def _creditors(
    sources: Sources,
    exclude_payment_providers: bool = True,
    label_since: date | None = None,
    creditor_ids: tuple[str, ...] | None = None,
) -> DataFrame:
    creditor = sources.table("creditor")
    if exclude_payment_providers:
        creditor = creditor.where(~F.col("is_payment_provider"))
    if label_since is not None:
        creditor = creditor.where(s.day(F.col("most_recent_risk_label_created_at")) >= F.lit(label_since))
    if creditor_ids is not None:
        creditor = creditor.where(F.col("id").isin(*creditor_ids))
    return creditor


def insolvent() -> Column:
    return s.in_set(F.col("creditor_risk_label_detail"), c.INSOLVENCY_LABELS).alias("insolvency_flag")


def creditor_flags(sources: Sources, creditor_ids: tuple[str, ...] | None = None) -> DataFrame:
    """What of a creditor decides alerts: few columns, and no organisation."""
    return _creditors(sources, creditor_ids=creditor_ids).select(
        F.col("id").alias("creditor_id"), "merchant_category_code", insolvent(), F.lit(1).alias("var1")
    )


def creditor_details(
    sources: Sources,
    require_active: bool = False,
    label_since: date | None = None,
    exclude_payment_providers: bool = True,
    managed: str | None = "flag",
    creditor_ids: tuple[str, ...] | None = None,
    organisation_creditor_ids: tuple[str, ...] | None = None,
) -> DataFrame:
    """Creditors with their organisation, one row per pair.

    ``managed`` is ``"flag"`` (ready-made column), ``"derived"`` (from the CRM
    flag and stage) or None. A predicate on an organisation column drops
    creditors without one, so those left joins run as inner joins.
    """
    creditor = _creditors(sources, exclude_payment_providers, label_since, creditor_ids)
    creditor = creditor.withColumn("insolvency_flag", insolvent())
    organisation = sources.table("organisation")
    joined = creditor.alias("a").join(
        organisation.alias("b"), F.col("a.organisation_id") == F.col("b.organisation_id"), "left"
    )
    if require_active:
        joined = joined.where(F.col("b.current_state") != c.INACTIVE_STATE)
    if organisation_creditor_ids is not None:
        joined = joined.where(F.col("b.creditor_id").isin(*organisation_creditor_ids))

    service = {
        None: [],
        "flag": [F.col("b.is_cs_managed"), F.col("b.csm_owner_name")],
        "derived": [
            managed_label(
                F.col("b.is_cs_managed_salesforce"), F.col("b.parent_account_stage")
            ).alias("is_cs_managed")
        ],
    }[managed]
    return joined.select(
        F.col("a.id").alias("creditor_id"),
        F.col("a.organisation_id"),
        F.col("a.name").alias("merchant_name"),
        F.col("a.geo"),
        F.col("a.merchant_category_code"),
        F.col("a.merchant_category_code_description"),
        F.col("a.creditor_risk_label_parent").alias("merchant_risk_label"),
        F.col("a.creditor_risk_label_detail").alias("merchant_risk_label_description"),
        F.col("a.most_recent_risk_label_created_at"),
        F.col("a.insolvency_flag"),
        F.col("a.creditor_created_date"),
        F.col("a.is_account_closed"),
        F.col("a.is_payment_provider"),
        F.col("a.organisation_with_multiple_creditors"),
        F.col("b.current_revenue_account_type").alias("account_type"),
        F.col("b.current_state"),
        F.col("b.parent_account_id"),
        F.col("b.parent_account_name"),
        *service,
        F.lit(1).alias("var1"),
    )


# --- Exposure, scores, balance ----------------------------------------------


def latest_exposure(sources: Sources) -> DataFrame:
    """Newest exposure snapshot per creditor; the larger amount wins a tie."""
    rows = sources.table("exposure").select(
        "creditor_id", s.money(F.col("amount_gbp")).alias("fds_exposure_current"), "calculated_at_date"
    )
    return latest(rows, ["creditor_id"], ["calculated_at_date", "fds_exposure_current"]).drop(
        "calculated_at_date"
    )


def _scored_reports(sources: Sources) -> DataFrame:
    """Reports that carry a score; only the nested leaves in use are read."""
    score = F.col("dnb_assessment.failure_score.national_percentile")
    return (
        sources.table("score_report")
        .where(score.isNotNull())
        .select(
            "creditor_id",
            F.col("legal_events.has_insolvency").alias("db_insolvency_flag"),
            score.alias("db_failure_score_current"),
            s.day(F.col("retrieved_at")).alias("db_failure_score_current_date"),
            "retrieved_at",
        )
    )


def latest_failure_score(sources: Sources) -> DataFrame:
    """Newest report with a score per creditor; the higher score wins a tie."""
    rows = _scored_reports(sources).drop("db_insolvency_flag")
    newest = latest(
        rows, ["creditor_id"], ["retrieved_at", "db_failure_score_current"], keep_number=True
    )
    return newest.drop("retrieved_at")


def failure_score_change(sources: Sources, as_of: date) -> DataFrame:
    """Yesterday's reports with the score and date of the report before each.

    A report's predecessor is either another one of yesterday or the newest
    earlier one, so history is cut to one row per creditor and only yesterday's
    rows are ordered. Reports are not deduplicated. The result is partitioned by
    creditor, as the merge needs it.
    """
    reports = _scored_reports(sources)
    yesterday = s.as_of_date(as_of, -1)
    order = ["retrieved_at", "db_failure_score_current"]
    retrieved_on = s.day(F.col("retrieved_at"))
    stepped = with_previous(
        reports.where(retrieved_on == yesterday),
        "creditor_id",
        order,
        {
            "db_failure_score_last": "db_failure_score_current",
            "db_failure_score_last_date": "db_failure_score_current_date",
        },
        bucket=F.date_trunc("hour", F.col("retrieved_at")),
        earlier=latest(reports.where(retrieved_on < yesterday), ["creditor_id"], order),
    )
    change = F.col("db_failure_score_current") - F.col("db_failure_score_last")
    stepped = stepped.withColumn("db_failure_score_change", change).drop("retrieved_at")
    return stepped.repartition("creditor_id")


def latest_default_probability(sources: Sources) -> DataFrame:
    """Newest prediction per creditor; dates are ``yyyymmdd`` text."""
    rows = sources.table("default_prediction").select(
        "creditor_id", "prediction_date", F.col("probability").alias("PD_score_latest")
    )
    newest = latest(rows, ["creditor_id"], ["prediction_date", "PD_score_latest"])
    return newest.select(
        "creditor_id",
        "prediction_date",
        s.compact_date(F.col("prediction_date")).alias("prediction_calendar_date"),
        "PD_score_latest",
    )


def yesterday_balance(sources: Sources, as_of: date) -> DataFrame:
    """Available funds per owner on the day before the run.

    The day is pinned by the filter, so grouping by the owner alone suffices
    and leaves the rows partitioned for the merge.
    """
    yesterday = s.as_of_date(as_of, -1)
    return (
        sources.table("daily_balance")
        .where((F.col("name") == c.BALANCE_NAME) & (F.col("calendar_date") == yesterday))
        .groupBy(F.col("owner_id").alias("creditor_id"))
        .agg(F.sum(s.money(F.col("balance_amount_sum_gbp"))).alias("balance_amount_sum_gbp"))
        .select("creditor_id", yesterday.alias("calendar_date"), "balance_amount_sum_gbp")
    )


# --- Payments ---------------------------------------------------------------

PAID_LAST_YEAR = Metric(
    "merchant_payment_amt_gbp_last_365d", "is_paid", "charge_date", -365, amount="amount_gbp"
)
NEXT_WEEK = Metric("future_payments_7days", None, "charge_date", 0, 7, amount="amount_gbp")
TRAILING = (
    Metric("merchant_payment_vol_last_30d", "is_paid", "charge_date", -30),
    Metric("merchant_chargeback_vol_last_30d", "is_charged_back", "charged_back_date", -30),
    Metric("merchant_payment_vol_last_90d", "is_paid", "charge_date", -90),
    Metric("merchant_chargeback_vol_last_90d", "is_charged_back", "charged_back_date", -90),
    Metric("merchant_failure_vol_last_90d", "is_failed", "failed_or_late_failure_date", -90),
    Metric("merchant_late_failure_vol_last_90d", "is_late_failure", "failed_or_late_failure_date", -90),
    Metric("merchant_refund_vol_last_90d", "is_refunded", "refund_created_at", -90),
    PAID_LAST_YEAR,
)
YEAR = (
    Metric("payment_vol_last_12m", "is_paid", "charge_date", -365),
    Metric("payment_amt_last_12m", "is_paid", "charge_date", -365, amount="amount_gbp"),
    Metric("chargeback_vol_last_12m", "is_charged_back", "charged_back_date", -365),
    Metric("chargeback_amt_last_12m", "is_charged_back", "charged_back_date", -365, amount="amount_gbp"),
)
YEAR_NAMES = tuple(m.name for m in YEAR)

RATES = {
    "cb_rate_30days": ("merchant_chargeback_vol_last_30d", "merchant_payment_vol_last_30d"),
    "cb_rate_90days": ("merchant_chargeback_vol_last_90d", "merchant_payment_vol_last_90d"),
    "failure_rate_90days": ("merchant_failure_vol_last_90d", "merchant_payment_vol_last_90d"),
    "late_failure_rate_90days": ("merchant_late_failure_vol_last_90d", "merchant_payment_vol_last_90d"),
    "refund_rate_90days": ("merchant_refund_vol_last_90d", "merchant_payment_vol_last_90d"),
}


def _charge_age(as_of: date):
    return s.days_since(as_of, s.day(F.col("charge_date")))


def payment_window_metrics(sources: Sources, as_of: date) -> DataFrame:
    """Counts and amounts per creditor over trailing windows.

    ``last_payment_days_ago`` is specified as the largest age, that of the
    oldest charge let in; ``newest_payment_days_ago`` is the smallest. The
    next-week amount sees only rows let in by a past event date.
    """
    age = _charge_age(as_of)
    return (
        payments_let_in(sources, TRAILING, as_of)
        .groupBy("creditor_id")
        .agg(
            NEXT_WEEK.column(as_of),
            *[m.column(as_of) for m in TRAILING],
            F.max(age).alias("last_payment_days_ago"),
            F.min(age).alias("newest_payment_days_ago"),
        )
    )


def payment_activity(sources: Sources, as_of: date) -> DataFrame:
    """Creditor metrics and the year's totals from one pass over payments.

    Lets in the union of what both need; ``rows_in_window`` tells which
    creditors ``payment_window_metrics`` would have seen.
    """
    inside = F.coalesce(any_window(TRAILING, as_of), F.lit(False))
    return (
        payments_let_in(sources, (*TRAILING, *YEAR), as_of)
        .groupBy("creditor_id")
        .agg(
            F.sum(F.when(inside, F.lit(1)).otherwise(F.lit(0))).alias("rows_in_window"),
            NEXT_WEEK.column(as_of, also=inside),
            *[m.column(as_of) for m in TRAILING],
            *[m.column(as_of) for m in YEAR],
        )
    )


def windowed_part(activity: DataFrame) -> DataFrame:
    """The creditors of ``payment_activity`` that the windowed filter lets in."""
    return activity.where(F.col("rows_in_window") > 0).drop("rows_in_window", *YEAR_NAMES)


def payment_rates(metrics: DataFrame) -> DataFrame:
    """Rates over paid volume; NULL without any. Other columns stay."""
    rates = {n: s.safe_divide(F.col(a), F.col(b)) for n, (a, b) in RATES.items()}
    used = {name for pair in RATES.values() for name in pair}
    return metrics.select(
        *[m for m in metrics.columns if m not in used], *[r.alias(n) for n, r in rates.items()]
    )


def ever_paying(sources: Sources) -> DataFrame:
    """Creditors with a payment at any time, possibly repeated.

    The kept table where the sources have one, else one column of the history.
    """
    name = "seen_creditor" if sources.has("seen_creditor") else "payment"
    return sources.table(name).select("creditor_id")


def paid_last_year(sources: Sources, as_of: date) -> DataFrame:
    """Paid amount of the year per creditor; creditors without any keep a 0.

    The sum reads the year's charge dates only. That an older creditor exists
    comes from ``ever_paying``.
    """
    name = PAID_LAST_YEAR.name
    payments = payments_let_in(sources, (PAID_LAST_YEAR,), as_of)
    year = payments.where(PAID_LAST_YEAR.matches(as_of)).select(
        "creditor_id", s.money(F.col(PAID_LAST_YEAR.amount)).alias(name)
    )
    ever = ever_paying(sources).withColumn(name, s.money(F.lit(0)))
    return year.unionByName(ever).groupBy("creditor_id").agg(F.sum(name).alias(name))


# --- Peers ------------------------------------------------------------------


def _category_members(sources: Sources) -> DataFrame:
    return creditor_flags(sources).select("creditor_id", "merchant_category_code")


def category_totals(activity: DataFrame, sources: Sources) -> DataFrame:
    """The year's volumes and chargeback rate per merchant category.

    Works on creditor totals, which is exact because sums add up, and keeps raw
    payments out of the join. Categories without a payment in the year are
    missing; ``with_idle_categories`` adds them.
    """
    totals = (
        activity.select("creditor_id", *YEAR_NAMES)
        .join(_category_members(sources), "creditor_id")
        .groupBy("merchant_category_code")
        .agg(*[F.sum(n).alias(f"mcc_{n}") for n in YEAR_NAMES])
    )
    return totals.withColumn(
        "mcc_chargeback_rate_vol_last_12m",
        s.safe_divide(F.col("mcc_chargeback_vol_last_12m"), F.col("mcc_payment_vol_last_12m")),
    )


def with_idle_categories(active: DataFrame, sources: Sources) -> DataFrame:
    """Adds categories whose payments are all older than the year, as zeros.

    Only creditors of categories not seen yet are looked up in ``ever_paying``,
    which is joined as one row a creditor, so a creditor with a third of the
    payments is one row per task. Where tables are staged it is known whether
    there are such creditors, and nothing is looked up without any.
    """
    code = "merchant_category_code"
    seen = active.select(F.col(code).alias("_seen"))
    members = _category_members(sources)
    unseen = stage(members.join(seen, F.col(code).eqNullSafe(F.col("_seen")), "left_anti"))
    if shared_folder(unseen.sparkSession) is not None and unseen.isEmpty():
        return active
    paying = ever_paying(sources).distinct()
    idle = unseen.join(paying, "creditor_id", "left_semi").select(code).distinct()
    blank = {
        field.name: F.lit(None if "rate" in field.name else 0).cast(field.dataType)
        for field in active.schema.fields
        if field.name != code
    }
    return stage(active.unionByName(idle.withColumns(blank)))


def peer_totals(sources: Sources, as_of: date, idle: bool = True) -> tuple[DataFrame, DataFrame]:
    """Creditor activity and category totals, each computed once and staged.

    A merchant with a rate has payments in the year, and so has its category:
    where only such merchants matter, ``idle=False`` spares the history.
    """
    activity = stage(payment_activity(sources, as_of))
    active = stage(category_totals(activity, sources))
    return activity, with_idle_categories(active, sources) if idle else active


def portfolio_totals(categories: DataFrame) -> DataFrame:
    """The same over all categories, as exactly one row keyed by ``var1``."""
    totals = categories.agg(*[F.sum(f"mcc_{n}").alias(f"portfolio_{n}") for n in YEAR_NAMES])
    return totals.select(
        F.lit(1).alias("var1"),
        "*",
        s.safe_divide(
            F.col("portfolio_chargeback_vol_last_12m"), F.col("portfolio_payment_vol_last_12m")
        ).alias("portfolio_chargeback_rate_vol_last_12m"),
    )


def peer_reference_rate(details: DataFrame, categories: DataFrame, min_chargebacks: int) -> DataFrame:
    """Merchants with their category's and the portfolio's totals, and the rate
    to compare with: the category's if it has enough chargebacks."""
    rows = spread_lookup(details, categories, "merchant_category_code", spread_by="creditor_id")
    rows = attach_one_row(rows, portfolio_totals(categories), "var1")
    return rows.withColumn("reference_cb_rate", reference_rate(min_chargebacks))


# --- History and tickets ----------------------------------------------------


def last_alert(sources: Sources, as_of: date, process: str, metric: str, names: dict[str, str]) -> DataFrame:
    """The newest logged result of a process per creditor.

    ``names`` gives the output columns for ``metric``, ``date``, ``days`` and
    ``trigger``. The process is pinned by the filter, so the creditor alone is
    the window key.
    """
    logged = read_results(sources.table("result_log"), process).select("values", "runtime")
    rows = log_fields(logged, "creditor_id", "ticket_id", metric).select(
        "creditor_id", "ticket_id", s.strict_double(F.col(metric)).alias(names["metric"]), "runtime"
    )
    newest = latest(rows, ["creditor_id"], ["runtime", "ticket_id", names["metric"]])
    logged = s.day(F.col("runtime"))
    return newest.select(
        "creditor_id",
        "ticket_id",
        names["metric"],
        logged.alias(names["date"]),
        s.days_since(as_of, logged).alias(names["days"]),
        F.lit(True).alias(names["trigger"]),
    )


CHARGEBACK_HISTORY = {
    "metric": "chargeback_monitoring_rate_last",
    "date": "chargeback_monitoring_date_last",
    "days": "chargeback_monitoring_days_since",
    "trigger": "chargeback_monitoring_trigger_last",
}
BALANCE_HISTORY = {
    "metric": "nb_balance_prev",
    "date": "neg_bal_monitoring_date_last",
    "days": "neg_bal_monitoring_days_since",
    "trigger": "neg_bal_monitoring_trigger_last",
}


def ticket_review_dates(sources: Sources) -> DataFrame:
    """Tickets with a readable next review date, and their organisation.

    Fields are pivoted per ticket before they meet the tickets, so a ticket's
    fields cross the shuffle once and pre-aggregated.
    """
    title, value = "ticket_field_title", F.col("ticket_field_value")
    reviews = pivot_fields(
        sources.table("ticket_field"),
        "ticket_id",
        title,
        {
            c.FIELD_NEXT_REVIEW: F.max(titled(title, c.FIELD_NEXT_REVIEW, s.safe_date(value))).alias(
                "next_review_date"
            ),
            c.FIELD_REVIEW_REASON: F.max(titled(title, c.FIELD_REVIEW_REASON, value)).alias(
                "reason_for_next_review"
            ),
        },
    ).where(F.col("next_review_date").isNotNull())
    owners = sources.table("ticket_org").select(
        F.col("id").alias("organization_id"), F.col("organisation_key")
    )
    tickets = (
        sources.table("ticket")
        .select(F.col("id").alias("ticket_id"), s.day(F.col("created_at")).alias("created_at"),
                "subject", "organization_id")
        .join(owners, "organization_id", "left")
    )
    return (
        tickets.join(reviews, "ticket_id")
        .groupBy("ticket_id", "created_at", "subject")
        .agg(
            F.max("next_review_date").alias("next_review_date"),
            F.max("reason_for_next_review").alias("reason_for_next_review"),
            F.max("organisation_key").alias("organisation_id"),
        )
    )


def sanctioned_exposure(sources: Sources, group_name: str = c.CREDIT_GROUP) -> DataFrame:
    """The ticket with the newest sanctioned date per creditor.

    Amount and date are text and compare as text. Order of evaluation: filter,
    aggregate, amount above zero, then newest per creditor. The amount filter
    reads the last aggregate, so it cannot move below the joins and raise on
    text of other groups' tickets.
    """
    title, value = "ticket_field_title", F.col("ticket_field_value")
    groups = sources.table("ticket_group").where(F.col("name") == group_name).select(
        F.col("id").alias("group_id")
    )
    of_group = (
        sources.table("ticket")
        .select(F.col("id").alias("ticket_id"), s.day(F.col("created_at")).alias("created_at"),
                "organization_id", "group_id")
        .join(groups, "group_id", "left_semi")
    )
    # Used twice: for the fields and for the tickets themselves.
    of_group = stage(of_group)
    # Fields of other groups' tickets go before the pivot.
    fields = pivot_fields(
        sources.table("ticket_field").join(of_group.select("ticket_id"), "ticket_id", "left_semi"),
        "ticket_id",
        title,
        {
            c.FIELD_SANCTIONED_AMOUNT: F.max(titled(title, c.FIELD_SANCTIONED_AMOUNT, value)).alias("amount"),
            c.FIELD_SANCTIONED_DATE: F.min(titled(title, c.FIELD_SANCTIONED_DATE, value)).alias("dated"),
        },
    )
    owners = sources.table("ticket_org").select(
        F.col("id").alias("organization_id"), F.col("organisation_key").alias("organisation_id")
    )
    merchants = sources.table("organisation").where(F.col("creditor_id").isNotNull()).select(
        "organisation_id", "creditor_id"
    )
    tickets = (
        of_group.join(fields, "ticket_id")
        .join(owners, "organization_id")
        .join(merchants, "organisation_id")
    )
    decided = (
        tickets.groupBy("creditor_id", F.col("ticket_id").alias("prev_ticket_id"), "created_at")
        .agg(
            F.max("amount").alias("Sanctioned_Credit_Risk_Exposure"),
            F.min("dated").alias("Sanctioned_Date"),
        )
        .where(s.strict_double(F.col("Sanctioned_Credit_Risk_Exposure")) > 0)
    )
    return latest(
        decided, ["creditor_id"], ["Sanctioned_Date", "prev_ticket_id", "created_at"], keep_number=True
    )


# --- Onboarding -------------------------------------------------------------


def latest_opportunity(sources: Sources, accounts: DataFrame | None = None) -> DataFrame:
    """Newest sales opportunity per account, of the given accounts if there are."""
    rows = sources.table("opportunity").select("account_id", "opportunity_id", "opportunity_created_date")
    if accounts is not None:
        rows = rows.join(accounts, "account_id", "left_semi")
    return latest(rows, ["account_id"], ["opportunity_created_date", "opportunity_id"])


def onboarding_amounts(sources: Sources, as_of: date, params: c.OnboardingParams) -> DataFrame:
    """New organisations with category code, opportunity and all-time amount.

    As specified the amount counts once per creditor of the organisation.
    Creditors are counted first and the amount multiplied, which gives the
    joined sum without fanning out a large organisation;
    ``dedupe_creditors`` counts it once.
    """
    fresh = (
        sources.table("organisation")
        .where(s.day(F.col("created_at")) >= s.as_of_date(as_of, -params.newer_than_days))
        .where(F.col("merchant_category_code").isNotNull())
        .select(
            "organisation_id",
            "account_id",
            "creditor_id",
            F.col("name").alias("merchant_name"),
            F.col("geo").alias("merchant_geo"),
            s.safe_long(F.col("merchant_category_code")).alias("merchant_category_code"),
            s.day(F.col("created_at")).alias("created_date"),
        )
    )
    facts = sources.table("organisation_fact").select(
        "organisation_id", s.money(F.col("total_payment_gbp_amount_in_all_time")).alias("amount")
    )
    joined = fresh.join(facts, "organisation_id", "left")
    amount = F.col("amount")
    if not params.dedupe_creditors:
        creditors = sources.table("creditor").join(fresh.select("organisation_id"), "organisation_id", "left_semi")
        sizes = creditors.groupBy("organisation_id").agg(F.count(F.lit(1)).alias("creditors"))
        joined = joined.join(sizes, "organisation_id", "left")
        amount = amount * F.coalesce(F.col("creditors"), F.lit(1)).cast("decimal(10,0)")
    opportunities = latest_opportunity(sources, fresh.select("account_id")).select(
        "account_id", F.col("opportunity_id").alias("salesforce_opportunity_id")
    )
    return (
        joined.join(opportunities, "account_id", "left")
        .groupBy(
            "creditor_id",
            "merchant_name",
            "merchant_geo",
            "salesforce_opportunity_id",
            "merchant_category_code",
            "created_date",
        )
        .agg(F.sum(amount).alias("payment_gbp_amount_in_all_time"))
    )
