"""Business vocabulary of the daily subscription report.

Everything in this module is data: the literal values the report compares
service rows against, and the 49 measure names with their report order.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES — these must equal the values used by the original daily
# report for results to match. Stated as plain text, in natural order.
# ---------------------------------------------------------------------------

# product_name values
STANDARD = "Standard"
PREMIUM = "Premium"
ANNUAL = "Annual"
BASIC = "Basic"

# service_status values
EXPIRED = "EXPIRED"
INACTIVE = "INACTIVE"
FINAL_BILL = "FINAL BILL"
ACTIVE = "ACTIVE"
HOLDONNPMT = "HOLDONNPMT"

# activation_method values
FREE_TRIAL = "FREE TRIAL"
VOUCHER = "VOUCHER"
PAYMENT = "PAYMENT"
PAYMENT_VOUCHER = "PAYMENT_VOUCHER"
UNKNOWN = "UNKNOWN"

# account status description that makes a VIP promotion count
ACCOUNT_STATUS_ACTIVE = "Active"

# promotion names that make an account VIP
VIP_PROMOTIONS = ("VIP", "SKY Employee Perk")

# content rule: every EPISODE, and FEATUREs whose labels contain the token
EPISODE = "EPISODE"
FEATURE = "FEATURE"
CONTENT_LABEL_TOKEN = "neon"

# coupon codes
DCB_COUPON_PREFIX = "SparkDCB"
DCB_EXCLUDED_PRIOR_COUPON = "SparkDCBProd1"
PARTNER_COUPON_PREFIX = "2DGBB"

# svod flag value
SVOD_YES = "Y"

# the value the attribution CASE assigns

# partner-voucher accounts left out of "Active 2Degrees"
PARTNER_EXCLUDED_IDS = (
    "2110202318461679981",
    "2110200127461647532",
    "2110202313461679535",
    "2110202325461684235",
)

# report order -> measure name (output data, kept verbatim incl. spelling)
MEASURE_NAMES = {
    1: "New Monthly Free Trialists",
    2: "Convert Trial to Pay",
    3: "Winback",
    4: "Churned Trialists",
    5: "Paying Churn",
    6: "Trial Ended",
    7: "New DCB",
    8: "DCB Churn",
    9: "DCB Pending Churn",
    10: "Closing Spark DCB",
    11: "Closing Direct Trialist Base",
    12: "Closing Monthly Paying Base",
    13: "Active DCB",
    14: "Suspended Accounts",
    15: "Neon Covert to DCB",
    16: "Total New Annual",
    17: "New Annual Signup",
    18: "Winback Annual",
    19: "Upgrade to Annual",
    20: "New Trialists L7D",
    21: "Active Trialists L7D",
    22: "Active Direct L30D",
    23: "Active DCB L30D",
    24: "Total Hours",
    25: "Unique Viewers",
    26: "Closing Annual Base",
    27: "Pending Annual",
    28: "New Annual Free Trialists",
    29: "Closing Annual Trialist Base",
    30: "Convert Annual Trial to Pay",
    31: "Annual Trial Ended",
    32: "Active Annual L30D",
    33: "New Basic Free Trialists",
    34: "Closing Basic Trialist Base",
    35: "Convert Basic Trial to Pay",
    36: "Basic Trial Ended",
    37: "Active Basic L30D",
    38: "Total New Basic",
    39: "Closing Basic Base",
    40: "New Basic Signup",
    41: "Winback Basic",
    42: "Downgrade to Basic",
    43: "Pending Basic",
    44: "Active 2Degrees",
    45: "Direct Pending Churn - Remaining Month",
    46: "Paying Churn - Basic",
    47: "Paying Churn - Annual",
    48: "New Trialists L7D - Basic",
    49: "New Trialists L7D - Annual",
}

# measures written as `... GROUP BY <report date>`: no row at all when the
# cohort is empty (every other measure reports 0)
NO_ROW_WHEN_EMPTY = frozenset({15, 20, 21, 22, 23, 24, 25, 32, 37, 48, 49})

# ---------------------------------------------------------------------------
# Derived groupings (not literals of their own)
# ---------------------------------------------------------------------------

MONTHLY = (STANDARD, PREMIUM)
ALL_PRODUCTS = (STANDARD, PREMIUM, ANNUAL, BASIC)
NOT_CURRENT = (EXPIRED, INACTIVE)
NON_PAYING_METHODS = (FREE_TRIAL, VOUCHER)
PAID_METHODS = (PAYMENT, PAYMENT_VOUCHER)
DCB_STATUSES = (ACTIVE, FINAL_BILL)
