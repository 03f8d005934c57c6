"""Parameters of the checked processes; the queries and their SQL share them."""

from __future__ import annotations

from datetime import date

from riskwatch import config as c

# Thresholds that leave rows on the driver's tables.
QUALIFIER = c.QualifierLimits(
    exposure_with_low_score=150_000, low_score_below=60, balance_at_most=-20_000, exposure_alone=300_000
)
SCORE_DROP = c.ScoreDropParams(qualifier=QUALIFIER)
CHARGEBACK = c.ChargebackParams(qualifier=QUALIFIER, min_peer_chargebacks=600)
NEGATIVE_BALANCE = c.NegativeBalanceParams()
SANCTIONED = c.SanctionedExposureParams()
RE_REVIEW = c.ReReviewParams(review_dates=tuple(date(2001, 8, d) for d in (2, 3, 4, 5)))
INSOLVENCY = c.InsolvencyParams(label_since=date(2000, 6, 1), limit=None)
