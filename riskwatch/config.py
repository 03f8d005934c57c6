"""Fixed values, ticket settings and pipeline parameters.

Everything a run depends on apart from its tables is an explicit argument: the
``as_of`` date, a frozen ``Params`` dataclass and ``TicketSettings``. Defaults
are the thresholds the processes are specified with.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

# --- Fixed values -----------------------------------------------------------
# Text and numbers that decide results. They are part of the processes'
# specification and have to match it exactly.

INSOLVENCY_LABELS = (
    "in_administration",
    "insolvency",
    "restructuring",
    "dissolved",
    "liquidation",
    "inactivity",
)

MANAGED_STAGES = ("CS Managed - Ent&MM", "CS Managed - SB")

INACTIVE_STATE = "preactive"

RESTRICTED_CODES = (
    4511, 4722, 4829, 5094, 5122, 5169, 5172, 5271, 5301, 5310, 5311, 5051,
    5551, 5561, 5571, 5592, 5598, 5715, 5912, 5913, 5921, 5933, 5944, 5962,
    5966, 5993, 5813, 7549, 6051, 6532, 7297, 6534, 6538, 7011, 7012, 7273,
    7277, 7322, 7995, 7996,
)

COMPLIANCE_CODES = (
    8249, 8211, 8241, 8244, 8299, 8220, 6529, 6533, 1711, 7629, 7699, 6300,
    6211, 6531, 6536, 7407, 7408, 7261, 7801, 7995, 5816, 7800,
)

# (lowest score, highest score or None, largest change that still alerts)
SCORE_DROP_BANDS = (
    (86, None, -30),
    (51, 85, -20),
    (30, 50, -10),
    (11, 29, -5),
    (1, 10, -2),
)

BALANCE_NAME = "available_merchant_funds"
RESULT_LOGTYPE = "result"

FIELD_NEXT_REVIEW = "Next Review Date"
FIELD_REVIEW_REASON = "Reason for next review"
FIELD_SANCTIONED_AMOUNT = "Sanctioned Credit Risk Exposure"
FIELD_SANCTIONED_DATE = "Sanctioned Date"
CREDIT_GROUP = "Credit"

PROCESS_SCORE_DROP = "Credit_Monitoring_DNB"
PROCESS_CHARGEBACK = "credit_chargeback_monitoring"
PROCESS_NEGATIVE_BALANCE = "credit_negative_balance"
PROCESS_SANCTIONED = "credit_sanctioned_exposure"
PROCESS_RE_REVIEW = "credit_re_review"
PROCESS_INSOLVENCY = "credit_insolvency"
PROCESS_ONBOARDING = "high_risk_onboarding"
PROCESS_TICKET_UPDATE = "Test_Oct15"
PROCESS_SINGLE_TICKET = "test_nov21"

NEW_ALERT = "New Alert"
NO_ALERT = "No Alert"
CHARGEBACK_INCREASE = "Chargeback Rate Increase >10% since last trigger"
CHARGEBACK_RETRIGGER = "Chargeback Rate Re-Trigger after 90 days"
BALANCE_DOUBLED = "Neg Balance Doubled Since Last Alert"
BALANCE_INCREASED = "Neg Balance Increased (90 days since last Trigger)"

CREATE_TICKET = "ActionField_ZendeskCreateTicket"
UPDATE_TICKET = "ActionField_ZendeskUpdateTicket"
FREEZE_ACCOUNT = "ActionField_FreezeAccount"
DISABLE_PAYOUTS = "ActionField_DisablePayouts"
CHANGE_HOLDING_PERIOD = "ActionField_ChangeHoldingPeriod"
APPLY_BALANCE_LIMITS = "ActionField_ApplyNegBalanceLimits"

# --- Ticket system ----------------------------------------------------------


@dataclass(frozen=True)
class TicketSettings:
    """Ids, links and footer of the ticket system a deployment talks to.

    Link prefixes and the footer belong to the deployment and are placeholders
    until it sets them.
    """

    # The specified ids of the ticket system.

    brand_id: int = 3285009
    group_id: int = 360005611314
    requester_id: int = 9724439852828
    ticket_form_id: int = 5636997079964
    assignee_id: int = 4451452073116
    category_field_id: int = 28480929
    exposure_field_id: int = 15542500163356
    fraud_score_field_id: int = 15545615128732
    update_form_id: int = 12443238293916
    update_ticket_id: int = 3417983
    admin_url: str = "https://admin.example.com/creditors/"
    ticket_url: str = "https://tickets.example.com/agent/tickets/"
    dashboard_url: str = "https://dashboards.example.com/underwriter"
    footer: str = "Created by merchant risk monitoring"
    #: Amounts and shares "trimmed" to their digits, or "padded" as their format says.
    amount_style: str = "trimmed"


# --- Pipeline parameters ----------------------------------------------------


@dataclass(frozen=True)
class QualifierLimits:
    """Which merchants are material enough to be monitored."""

    exposure_with_low_score: float = 250_000
    low_score_below: int = 40
    balance_at_most: float = -20_000
    exposure_alone: float = 500_000


@dataclass(frozen=True)
class ScoreDropParams:
    qualifier: QualifierLimits = field(default_factory=QualifierLimits)
    bands: tuple = SCORE_DROP_BANDS
    require_qualifier: bool = True
    exclude_insolvent: bool = True
    only_alerts: bool = True
    category_tag: str = "credit__monitoring_fs"
    creditor_ids: tuple[str, ...] | None = None


@dataclass(frozen=True)
class ChargebackParams:
    qualifier: QualifierLimits = field(default_factory=QualifierLimits)
    above_reference: float = 0.04
    above_last: float = 0.1
    retrigger_days: int = 90
    min_peer_chargebacks: int = 1000
    require_qualifier: bool = True
    only_alerts: bool = True
    category_tag: str = "credit__monitoring_cb"
    creditor_ids: tuple[str, ...] | None = None


@dataclass(frozen=True)
class NegativeBalanceParams:
    growth_ratio: float = 2
    retrigger_days: int = 90
    max_balance: float | None = None
    exclude_insolvent: bool = False
    only_alerts: bool = False
    max_last_payment_days: int | None = None
    category_tag: str = "credit__monitoring_nb"
    creditor_ids: tuple[str, ...] | None = None


@dataclass(frozen=True)
class SanctionedExposureParams:
    exceeds_by: float = 1.2
    min_exposure: float = 200_000
    exclude_insolvent: bool = True
    group_name: str = CREDIT_GROUP
    category_tag: str = "credit__monitoring_nb"
    subject_topic: str = "Negative Balance"
    creditor_ids: tuple[str, ...] | None = None


@dataclass(frozen=True)
class ReReviewParams:
    #: Review dates that are due; None: the run date and the day after.
    review_dates: tuple[date, ...] | None = None
    category_tag: str = "credit__monitoring_rr"
    creditor_ids: tuple[str, ...] | None = None


@dataclass(frozen=True)
class InsolvencyParams:
    label_since: date = date(2024, 9, 4)
    min_exposure: float = 100_000
    min_paid: float = 1_000_000
    subject: str = "This is s test do not Panic!!! 1"
    limit: int | None = None
    creditor_ids: tuple[str, ...] | None = None


@dataclass(frozen=True)
class OnboardingParams:
    newer_than_days: int = 1
    restricted_codes: tuple[int, ...] = RESTRICTED_CODES
    compliance_codes: tuple[int, ...] = COMPLIANCE_CODES
    dedupe_creditors: bool = False


@dataclass(frozen=True)
class TicketUpdateParams:
    exposure_value: str = "55555"
    fraud_score_value: str = "123"
    body: str = "This is a test editing the ticket"
    limit: int | None = None


@dataclass(frozen=True)
class SingleTicketParams:
    creditor_ids: tuple[str, ...] | None = None
    priority: str = "high"
    subject: str = "TEST TEST TETSe - "
    note: str = "This is a test"
