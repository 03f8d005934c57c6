"""Ticket payloads: bodies, subjects and the JSON around them.

Headings, labels and their order are fixed text that readers of the tickets
and tools behind them rely on.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskwatch.config import TicketSettings
from riskwatch.functions.scalars import day, ticket_fields, to_json_text
from riskwatch.functions.text import (
    ONE_DECIMAL,
    TWO_DECIMALS,
    formatted,
    joined,
    number,
    or_missing,
    percent,
    plain,
)

col = F.col


@dataclass(frozen=True)
class Line:
    """``**label:** value`` on its own line of a Markdown body."""

    label: str
    value: Column
    before: str = " "
    after: str = ""

    def text(self) -> Column:
        return joined(f"**{self.label}:**{self.before}", self.value, self.after)


def lines(*entries: Line) -> Column:
    parts: list[Column | str] = []
    for i, entry in enumerate(entries):
        parts += ["\n", entry.text()] if i else [entry.text()]
    return joined(*parts)


def section(heading: str, *entries: Line) -> Column:
    return joined(f"**{heading}:**\n", lines(*entries))


def markdown_body(settings: TicketSettings, *sections: Column) -> Column:
    """Sections, the dashboard link and the footer."""
    link = joined(
        f"**Link to underwriter’s dashboard:** [Underwriter Dashboard]({settings.dashboard_url}?Organisation+ID=",
        or_missing(col("organisation_id")),
        "&Creditor+ID=&Company+Number=)",
    )
    parts: list[Column | str] = []
    for block in sections:
        parts += [block, "\n\n"]
    return joined(*parts, link, f"\n\n\n{settings.footer}")


def plain_body(entries: list[tuple[str, Column]]) -> Column:
    """``label: value`` lines; NULL as soon as a value is NULL."""
    parts: list[Column | str] = []
    for i, (label, value) in enumerate(entries):
        parts += [f"{label}: " if i == 0 else f"\n{label}: ", value]
    return joined(*parts)


# --- Sections shared by the Markdown bodies ---------------------------------


def amount(settings: TicketSettings, name: str, form: str = ONE_DECIMAL) -> Column:
    return or_missing(formatted(col(name), form, settings.amount_style))


def rate(settings: TicketSettings, name: str, form: str = TWO_DECIMALS) -> Column:
    return or_missing(percent(col(name), form, settings.amount_style))


def value(name: str) -> Column:
    return or_missing(plain(col(name)))


def merchant_section(settings: TicketSettings) -> Column:
    identity = value("creditor_id")
    linked = joined("[", identity, f"]({settings.admin_url}", identity, ")")
    return section(
        "Merchant Details",
        Line("Creditor ID", linked),
        Line("Organisation ID", value("organisation_id")),
        Line("Merchant name", value("merchant_name")),
        Line("Geo", value("geo")),
        Line("MCC", value("merchant_category_code_description")),
        Line("Payment provider", value("is_payment_provider")),
        Line("Account Type", value("account_type")),
        Line("CS Managed", value("is_cs_managed")),
        Line("CS Manager Name", value("csm_owner_name")),
    )


def parent_section() -> Column:
    return section(
        "Parent Information",
        Line("Parent ID", value("parent_account_id")),
        Line("Parent Name", value("parent_account_name")),
    )


def label_section() -> Column:
    labelled = or_missing(plain(day(col("most_recent_risk_label_created_at"))))
    return section(
        "Risk Labels",
        Line("Risk Label", value("merchant_risk_label_description")),
        Line("Risk Label Date", labelled),
    )


def score_section() -> Column:
    return section(
        "Failure Score",
        Line("D&B Score", value("db_failure_score_current")),
        Line("D&B Score date", value("db_failure_score_current_date")),
        Line("Internal PD Score", or_missing(number(F.round(col("PD_score_latest"), 2)))),
        Line("Internal PD Score date", value("prediction_calendar_date")),
    )


def payment_section(settings: TicketSettings, with_exposure: bool = True) -> Column:
    exposure = [Line("FDS Exposure", amount(settings, "fds_exposure_current"), " £")] if with_exposure else []
    return section(
        "Payment Information",
        *exposure,
        Line("Payments last 12m", amount(settings, "merchant_payment_amt_gbp_last_365d"), " £"),
        Line("Chargeback rate (90days)", rate(settings, "cb_rate_90days"), after="%"),
        Line("Failure rate (90days)", rate(settings, "failure_rate_90days"), after="%"),
        Line("Late Failure rate (90days)", rate(settings, "late_failure_rate_90days"), after="%"),
        Line("Refund rate (90days)", rate(settings, "refund_rate_90days"), after="%"),
    )


def ticket_link(settings: TicketSettings, ticket: Column) -> Line:
    linked = joined("[", ticket, f"]({settings.ticket_url}", ticket, ")")
    return Line("Previous ticket link here", linked)


# --- Sections of single processes -------------------------------------------


def chargeback_section(settings: TicketSettings) -> Column:
    """Differs by history; with history a NULL ticket id makes it NULL."""
    repeated = lines(
        ticket_link(settings, col("ticket_id")),
        Line("CB Rate Previously", rate(settings, "chargeback_monitoring_rate_last"), after="%"),
        Line("CB Rate Now", rate(settings, "cb_rate_30days"), after="%"),
        Line("Reference CB Rate", rate(settings, "reference_cb_rate"), after="%"),
        Line("Date Last Trigger", value("chargeback_monitoring_date_last")),
        Line("Days Since Last Trigger", value("chargeback_monitoring_days_since")),
    )
    first = lines(
        Line("CB Rate", rate(settings, "cb_rate_30days"), after="%"),
        Line("Reference CB Rate", rate(settings, "reference_cb_rate"), after="%"),
    )
    case = Line("Case Type", value("chargeback_monitoring_alert"))
    return joined(
        "**Chargeback monitoring details:** \n",
        case.text(),
        "\n",
        F.when(col("chargeback_monitoring_trigger_last"), repeated).otherwise(first),
    )


def negative_balance_section(settings: TicketSettings) -> Column:
    """Differs by history; a missing ticket id is spelled out."""
    now = Line("NB Now", amount(settings, "nb_balance_current", TWO_DECIMALS))
    repeated = lines(
        ticket_link(settings, value("ticket_id")),
        Line("Previous NB", amount(settings, "nb_balance_prev", TWO_DECIMALS)),
        now,
        Line("NB Increase", amount(settings, "NB_Increase", TWO_DECIMALS)),
    )
    case = Line("Case Type", value("nb_alert_type"))
    return joined(
        "**Negative Balance monitoring details:** \n",
        case.text(),
        "\n",
        F.when(col("neg_bal_monitoring_trigger_last"), repeated).otherwise(lines(now)),
    )


def sanctioned_section(settings: TicketSettings) -> Column:
    share = rate(settings, "FDS_Increase", ONE_DECIMAL)
    return section(
        "Sanctioned FDS - Alert Information",
        Line("Sanctioned FDS Exposure", amount(settings, "Sanctioned_Credit_Risk_Exposure"), " £"),
        Line("Current FDS Exposure", amount(settings, "fds_exposure_current"), " £"),
        Line("Current FDS in % of sanctioned amount", share, "", "%"),
    )


def balance_section(settings: TicketSettings) -> Column:
    return section(
        "Negative Balance", Line("Current Negative Balance", amount(settings, "nb_balance_current"), " £")
    )


def review_section(settings: TicketSettings) -> Column:
    ticket = F.coalesce(plain(col("ticket_id")), F.lit("0"))
    return lines(
        Line("Original ticket created at", plain(day(col("ticket_created_at")))),
        ticket_link(settings, ticket),
        Line("Stated review reason", value("reason_for_next_review")),
    )


# --- Whole bodies -----------------------------------------------------------


def _standard(settings: TicketSettings, *rest: Column) -> Column:
    opening = [merchant_section(settings), parent_section(), label_section(), score_section()]
    return markdown_body(settings, *opening, *rest)


def chargeback_body(settings: TicketSettings) -> Column:
    return _standard(settings, payment_section(settings), chargeback_section(settings))


def negative_balance_body(settings: TicketSettings) -> Column:
    return _standard(settings, payment_section(settings), negative_balance_section(settings))


def sanctioned_body(settings: TicketSettings) -> Column:
    return _standard(settings, payment_section(settings, with_exposure=False), sanctioned_section(settings))


def re_review_body(settings: TicketSettings) -> Column:
    return _standard(settings, balance_section(settings), payment_section(settings), review_section(settings))


def score_drop_body(settings: TicketSettings) -> Column:
    """Plain text; scores have no default, so a NULL score makes it NULL."""

    def known(name: str) -> Column:
        return or_missing(plain(col(name)), "")

    def rounded(name: str) -> Column:
        return or_missing(number(F.round(col(name), 2)), "")

    head = plain_body([
        ("Creditor ID", known("creditor_id")),
        ("Organisation ID", known("organisation_id")),
        ("Merchant name", known("merchant_name")),
        ("Geo", known("geo")),
        ("MCC", known("merchant_category_code_description")),
        ("Payment provider", or_missing(plain(col("is_payment_provider")), "false")),
        ("CS Managed?", known("is_cs_managed")),
        ("Current Risk Label", known("merchant_risk_label_description")),
        ("Parent ID", known("parent_account_id")),
        ("Parent Name", known("parent_account_name")),
        ("Account Type", known("account_type")),
        ("Payments last 12m", rounded("merchant_payment_amt_gbp_last_365d")),
        ("FDS Exposure", rounded("fds_exposure_current")),
        ("Negative Balance", or_missing(number(col("nb_balance_current")), "0")),
    ])
    scores = plain_body([
        ("Current D&B Score", plain(col("db_failure_score_current"))),
        ("Previous D&B Score", plain(col("db_failure_score_last"))),
        ("Score Change", plain(col("db_failure_score_change"))),
    ])
    return joined(head, "\n\n\n", scores, f"\n\n\n{settings.footer}")


def insolvency_body() -> Column:
    """Plain text without defaults: any NULL makes it NULL."""
    return plain_body([
        ("Creditor ID", col("creditor_id")),
        ("Organisation ID", col("organisation_id")),
        ("Merchant name", col("merchant_name")),
        ("Geo", col("geo")),
        ("MCC", col("merchant_category_code_description")),
        ("Payment provider", plain(col("is_payment_provider"))),
        ("Insolvency flag", plain(col("insolvency_flag"))),
        ("Risk Label Date", plain(col("most_recent_risk_label_created_at"))),
        ("Parent ID", col("parent_account_id")),
        ("Parent Name", col("parent_account_name")),
        ("Account Type", col("account_type")),
        ("Payments last 12m", number(F.round(col("merchant_payment_amt_gbp_last_365d"), 2))),
        ("FDS Exposure", number(F.round(col("fds_exposure_current"), 2))),
    ])


def single_body(settings: TicketSettings, note: str) -> Column:
    return joined("**Merchant Name:**", col("merchant_name"), note, f"\n\n\n{settings.footer}")


# --- Subjects ---------------------------------------------------------------


def subject(topic: str, default: str | None = None) -> Column:
    """Topic, merchant and creditor; NULL-propagating without a default."""
    name, creditor = col("merchant_name"), col("creditor_id")
    if default is not None:
        name, creditor = or_missing(name, default), or_missing(creditor, default)
    return joined(f"Credit Monitoring - {topic} - ", name, " - ", creditor)


# --- JSON documents ---------------------------------------------------------


def _comment(body: Column) -> Column:
    return F.struct(body.alias("body"), F.lit(False).alias("public"))


def _document(**fields: Column) -> Column:
    ticket = F.struct(*[v.alias(k) for k, v in fields.items()])
    return to_json_text(F.struct(ticket.alias("ticket")))


def create_ticket(
    settings: TicketSettings, body: Column, subject_text: Column, tag: str | None, assign: bool = True
) -> Column:
    """Create-ticket document; without a tag the custom fields stay empty."""
    assignee = {"assignee_id": F.lit(settings.assignee_id).cast("bigint")} if assign else {}
    tags = [] if tag is None else [(settings.category_field_id, tag)]
    return _document(
        priority=F.lit("normal"),
        brand_id=F.lit(settings.brand_id).cast("bigint"),
        group_id=F.lit(settings.group_id).cast("bigint"),
        requester_id=F.lit(settings.requester_id).cast("bigint"),
        ticket_form_id=F.lit(settings.ticket_form_id).cast("bigint"),
        **assignee,
        custom_fields=ticket_fields(*tags),
        comment=_comment(body),
        subject=subject_text,
    )


def create_short_ticket(settings: TicketSettings, priority: str, body: Column, subject_text: Column) -> Column:
    """Reduced create-ticket document."""
    return _document(
        priority=F.lit(priority),
        ticket_form_id=F.lit(settings.ticket_form_id).cast("bigint"),
        comment=_comment(body),
        subject=subject_text,
    )


def update_ticket(settings: TicketSettings, exposure: str, fraud_score: str, body: str) -> Column:
    """Update-ticket document with two custom fields."""
    return _document(
        ticket_form_id=F.lit(settings.update_form_id).cast("bigint"),
        custom_fields=ticket_fields(
            (settings.exposure_field_id, exposure), (settings.fraud_score_field_id, fraud_score)
        ),
        comment=_comment(F.lit(body)),
    )
