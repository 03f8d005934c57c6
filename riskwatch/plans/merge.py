"""Merged relations: one row per creditor with everything a process needs.

Most processes decide on a few columns and show many. Where the caller passes
the predicate it decides by as ``keep``, the rows it keeps are staged first, and
the remaining features are computed for their creditors only.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskwatch import config as c
from riskwatch.functions.scalars import day, negative_part, strict_double
from riskwatch.operators.joins import many_to_many, star_merge
from riskwatch.operators.staging import shared_folder, stage
from riskwatch.plans import features as f
from riskwatch.sources.tables import Sources

IDENTITY = (
    "creditor_id", "organisation_id", "merchant_name", "geo", "merchant_category_code",
    "merchant_category_code_description", "is_payment_provider", "account_type",
    "merchant_risk_label", "merchant_risk_label_description",
)
SCORES = ("db_failure_score_current", "db_failure_score_current_date")
PREDICTION = ("PD_score_latest", "prediction_calendar_date")
RATES_90 = ("cb_rate_90days", "failure_rate_90days", "late_failure_rate_90days", "refund_rate_90days")
PAID = "merchant_payment_amt_gbp_last_365d"


def balance_now() -> Column:
    return negative_part(F.col("balance_amount_sum_gbp")).alias("nb_balance_current")


def rounded(name: str) -> Column:
    """Amounts rounded to one decimal, half away from zero, before the rules."""
    return F.round(F.col(name), 1).alias(name)


def label_day() -> Column:
    name = "most_recent_risk_label_created_at"
    return day(F.col(name)).alias(name)


def _staged(kept: DataFrame, sources: Sources) -> tuple[DataFrame, Sources]:
    """The kept rows, and sources reduced to their creditors.

    Staged rows are a table of known size, and the facts are semi-joined with
    their ids as Spark sees fit. A plan that stays lazy would have to compute the
    rows again for each fact table, so there the facts are used as they are; the
    later left joins give the same rows.
    """
    kept = stage(kept)
    staged = shared_folder(kept.sparkSession) is not None
    return kept, sources.of_creditors(kept) if staged else sources


def _decided(base: DataFrame, keep: Column | None, sources: Sources) -> tuple[DataFrame, Sources]:
    """The rows that ``keep`` keeps, if it is given, as ``_staged`` does."""
    return (base, sources) if keep is None else _staged(base.where(keep), sources)


def score_drop(
    sources: Sources,
    as_of: date,
    creditor_ids: tuple[str, ...] | None = None,
    keep: Column | None = None,
    exclude_insolvent: bool = False,
) -> DataFrame:
    """``keep`` may use the score columns; merchants are read for kept scores only."""
    change, reduced, how = f.failure_score_change(sources, as_of), sources, "left"
    if keep is not None:
        change, reduced = _staged(change.where(keep), sources)
        how = "inner"
    details = f.creditor_details(reduced, require_active=True, managed="derived", creditor_ids=creditor_ids)
    if exclude_insolvent:
        details = details.where(~F.col("insolvency_flag"))
    base = details.join(change, "creditor_id", how)
    merged = star_merge(
        base,
        [f.latest_exposure(reduced), f.yesterday_balance(reduced, as_of), f.paid_last_year(reduced, as_of)],
        "creditor_id",
    )
    return merged.select(
        *IDENTITY,
        "insolvency_flag", "current_state", "is_cs_managed", "parent_account_id", "parent_account_name",
        "fds_exposure_current",
        *SCORES,
        "db_failure_score_last", "db_failure_score_last_date", "db_insolvency_flag",
        "db_failure_score_change",
        balance_now(),
        PAID,
    )


def chargeback(
    sources: Sources,
    as_of: date,
    params: c.ChargebackParams,
    idle: bool = True,
    keep: Column | None = None,
) -> DataFrame:
    """Payments are read once: their creditor totals are staged, then used for
    the creditor's own rates and, rolled up, for the reference rates.

    Category totals are staged as well: two relations read them, and their
    known size decides how they are joined. With ``keep``, which may use the
    rates and the history, merchants are decided as narrow rows, and their other
    columns are read for kept ones only.
    """
    activity, categories = f.peer_totals(sources, as_of, idle)
    history = f.last_alert(sources, as_of, c.PROCESS_CHARGEBACK, "cb_rate_30days", f.CHARGEBACK_HISTORY)
    rates = f.payment_rates(f.windowed_part(activity))

    def judged(merchants: DataFrame) -> DataFrame:
        compared = f.peer_reference_rate(merchants, categories, params.min_peer_chargebacks)
        return star_merge(compared, [rates, history], "creditor_id")

    if keep is None:
        base, reduced = judged(f.creditor_details(sources, creditor_ids=params.creditor_ids)), sources
    else:
        narrow = f.creditor_flags(sources, params.creditor_ids).drop("insolvency_flag")
        key = ["creditor_id", "merchant_category_code"]
        # All columns follow from these two, so a repeated creditor is one row here.
        decided, reduced = _staged(judged(narrow).where(keep).dropDuplicates(key), sources)
        decided = decided.drop("var1").withColumnRenamed("merchant_category_code", "_category")
        same = F.col("merchant_category_code").eqNullSafe(F.col("_category"))
        details = f.creditor_details(reduced, creditor_ids=params.creditor_ids)
        base = details.join(decided.withColumnRenamed("creditor_id", "_creditor"),
                            (F.col("creditor_id") == F.col("_creditor")) & same)
    merged = star_merge(
        base,
        [
            f.latest_exposure(reduced),
            f.latest_failure_score(reduced).drop("rowno"),
            f.yesterday_balance(reduced, as_of),
            f.latest_default_probability(reduced),
        ],
        "creditor_id",
    )
    names = [*f.YEAR_NAMES, "chargeback_rate_vol_last_12m"]
    return merged.select(
        *IDENTITY,
        "most_recent_risk_label_created_at", "insolvency_flag", "current_state", "is_cs_managed",
        "csm_owner_name", "parent_account_id", "parent_account_name",
        "fds_exposure_current",
        *SCORES,
        balance_now(),
        "cb_rate_30days",
        PAID,
        *RATES_90,
        *[f"mcc_{n}" for n in names],
        *[f"portfolio_{n}" for n in names],
        "reference_cb_rate",
        "ticket_id",
        *f.CHARGEBACK_HISTORY.values(),
        *PREDICTION,
    )


def _standard(base: DataFrame, sources: Sources, as_of: date) -> DataFrame:
    """Scores, balance and payments; the exposure is joined by the caller."""
    return star_merge(
        base,
        [
            f.latest_failure_score(sources).drop("rowno"),
            f.latest_default_probability(sources),
            f.yesterday_balance(sources, as_of),
            f.payment_rates(f.payment_window_metrics(sources, as_of)),
        ],
        "creditor_id",
    )


def rounded_exposure(sources: Sources) -> DataFrame:
    return f.latest_exposure(sources).select("creditor_id", rounded("fds_exposure_current"))


def _standard_columns(with_last_payment: bool) -> list:
    return [
        *IDENTITY,
        label_day(),
        "insolvency_flag", "parent_account_id", "parent_account_name", "is_cs_managed", "csm_owner_name",
        "fds_exposure_current",
        *SCORES,
        *PREDICTION,
        balance_now(),
        rounded(PAID),
        *RATES_90,
        *(["last_payment_days_ago"] if with_last_payment else []),
    ]


def negative_balance(
    sources: Sources,
    as_of: date,
    creditor_ids: tuple[str, ...] | None = None,
    keep: Column | None = None,
) -> DataFrame:
    """``keep`` may use the insolvency flag, the balance and the history. Without
    it every merchant is in the result and nothing is decided beforehand."""

    def history(tables: Sources) -> DataFrame:
        return f.last_alert(tables, as_of, c.PROCESS_NEGATIVE_BALANCE, "nb_balance_current", f.BALANCE_HISTORY)

    reduced = sources
    if keep is not None:
        facts = [f.yesterday_balance(sources, as_of), history(sources)]
        narrow = star_merge(f.creditor_flags(sources, creditor_ids), facts, "creditor_id")
        decided = narrow.select("*", balance_now()).where(keep).select("creditor_id").distinct()
        kept, reduced = _staged(decided, sources)
    details = f.creditor_details(reduced, creditor_ids=creditor_ids)
    if keep is not None:
        details = details.join(kept, "creditor_id", "left_semi")
    base = star_merge(details, [rounded_exposure(reduced)], "creditor_id")
    merged = star_merge(_standard(base, reduced, as_of), [history(reduced)], "creditor_id")
    return merged.select(
        *_standard_columns(with_last_payment=True),
        "ticket_id",
        "neg_bal_monitoring_date_last",
        "nb_balance_prev",
        "neg_bal_monitoring_days_since",
        "neg_bal_monitoring_trigger_last",
    )


def sanctioned(
    sources: Sources,
    as_of: date,
    group_name: str = c.CREDIT_GROUP,
    creditor_ids: tuple[str, ...] | None = None,
    keep: Column | None = None,
) -> DataFrame:
    """``keep`` may use the merchant's columns, the ticket's and the exposure."""
    amount = "Sanctioned_Credit_Risk_Exposure"
    tickets = f.sanctioned_exposure(sources, group_name).drop("rowno")
    tickets = tickets.withColumn(amount, strict_double(F.col(amount)))
    details = f.creditor_details(sources, creditor_ids=creditor_ids)
    # Only merchants with a sanctioned ticket can be kept: they come first, and
    # exposures are looked up for them alone.
    ticketed = None if keep is None else F.col(amount).isNotNull()
    base, reduced = _decided(star_merge(details, [tickets], "creditor_id"), ticketed, sources)
    base = star_merge(base, [rounded_exposure(reduced)], "creditor_id")
    base = base if keep is None else base.where(keep)
    return _standard(base, reduced, as_of).select(
        *_standard_columns(with_last_payment=True), "prev_ticket_id", "created_at", "Sanctioned_Date", amount
    )


def re_review(
    sources: Sources,
    as_of: date,
    creditor_ids: tuple[str, ...] | None = None,
    keep: Column | None = None,
) -> DataFrame:
    """One row per creditor and review ticket of its organisation.

    ``keep`` may use the ticket's columns. Facts are joined while a creditor is
    one row; the tickets multiply the rows last, and an organisation with many
    creditors and many tickets is cut into cells.
    """
    tickets = f.ticket_review_dates(sources).drop("subject").withColumnRenamed("created_at", "ticket_created_at")
    tickets = stage(tickets if keep is None else tickets.where(keep))
    base, reduced = f.creditor_details(sources, creditor_ids=creditor_ids), sources
    if keep is not None:
        owners = tickets.select("organisation_id").distinct()
        base, reduced = _staged(base.join(owners, "organisation_id", "left_semi"), sources)
    merged = star_merge(base, [rounded_exposure(reduced)], "creditor_id")
    merged = many_to_many(
        _standard(merged, reduced, as_of),
        tickets,
        "organisation_id",
        left_by="creditor_id",
        right_by="ticket_id",
        how="left" if keep is None else "inner",
        counted=base,
    )
    return merged.select(
        *_standard_columns(with_last_payment=False),
        "ticket_id",
        "ticket_created_at",
        "next_review_date",
        "reason_for_next_review",
    )


def insolvency(
    sources: Sources, as_of: date, params: c.InsolvencyParams, keep: Column | None = None
) -> DataFrame:
    """``keep`` may use the merchant's columns."""
    details = f.creditor_details(
        sources,
        require_active=True,
        label_since=params.label_since,
        managed=None,
        creditor_ids=params.creditor_ids,
    )
    base, reduced = _decided(details, keep, sources)
    merged = star_merge(base, [rounded_exposure(reduced), f.paid_last_year(reduced, as_of)], "creditor_id")
    return merged.select(
        *IDENTITY,
        label_day(),
        "insolvency_flag", "parent_account_id", "parent_account_name",
        "fds_exposure_current",
        rounded(PAID),
    )
