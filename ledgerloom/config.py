"""Fixed values and default parameters shared by the models.

Values under "fixed values" are the business rules' constants; they are
stated once here so models, tests and the SQL oracle agree.
"""

import datetime as _dt

# ---------------------------------------------------------------- fixed values
# Soft-delete / status vocabularies used by the models.
CANCEL_STATUSES = ("cancelled", "returned")
OPEN_TICKET_STATUS = "open"
BILLING_ISSUE = "billing"
DELIVERY_ISSUE = "delivery"

# B2B health score: 100 - 10 per open ticket - 20 when return rate > 0.2, floor 0.
HEALTH_BASE = 100
HEALTH_PER_OPEN_TICKET = 10
HEALTH_RATE_PENALTY = 20
HEALTH_RATE_PENALTY_ABOVE = 0.2
AT_RISK_OPEN_TICKETS = 3
AT_RISK_RETURN_RATE = 0.3

# Customer value segments by percent rank of units purchased (desc, nulls first).
HIGH_VALUE_MAX_PCT_RANK = 0.20
MID_VALUE_MAX_PCT_RANK = 0.60

# Loyalty campaign targeting.
VIP_TIERS = ("Gold", "Platinum")
UPGRADE_TIERS = ("Bronze", "Silver")
WIN_BACK_AFTER_DAYS = 180

# Regional attainment: at_risk when actual >= 80 % of target.
AT_RISK_ATTAINMENT = 0.8

# Finance: trailing window in months.
RECENT_MONTHS = 6

# Source freshness bands (hours since last sync).
FRESHNESS_WARN_HOURS = 7
FRESHNESS_ERROR_HOURS = 13

# Time spine bounds of the metric layer (end exclusive).
SPINE_START = _dt.date(2022, 1, 1)
SPINE_END_EXCLUSIVE = _dt.date(2030, 1, 1)

# Question-layer bands.
LTV_HIGH_MIN = 500
LTV_MID_MIN = 100
PRICE_PREMIUM_MIN = 1000
PRICE_MID_MIN = 200

# ---------------------------------------------------------------- parameters
# "current_date" of the models is a parameter so results are reproducible.
DEFAULT_AS_OF = _dt.date(1998, 7, 1)
# Reference time of the simulated source sync and of the freshness check.
SYNC_TS = _dt.datetime(2001, 12, 1, 0, 0, 0)
FRESHNESS_AS_OF = _dt.datetime(2001, 12, 1, 0, 25, 0)
