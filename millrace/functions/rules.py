"""Business limits used across the jobs.

Fixed values: results only agree with the published ones when these limits,
rates, labels and patterns are exactly as listed.
"""

# --- fixed values -----------------------------------------------------------
AMOUNT_BANDS = ((1000, "HIGH"), (300, "MEDIUM"))
SALARY_BANDS = ((100000, "HIGH"), (50000, "MEDIUM"))
BAND_DEFAULT = "LOW"
ADULT_AGE = 30

RISK_HIGH_TOTAL, RISK_HIGH_SINGLE = 50000, 40000
RISK_MEDIUM_TOTAL, RISK_MEDIUM_SINGLE, RISK_MEDIUM_COUNT = 5000, 1000, 10

GST_RATE = "0.18"
TAX_BANDS = ((100000, "0.30"), (50000, "0.20"))
TAX_DEFAULT = "0.10"

VITAL_RANGES = (
    ("heart_rate", 50.0, 120.0, "HeartRate"),
    ("spo2", 92.0, 100.0, "SpO2"),
    ("systolic_bp", 90.0, 140.0, "BP"),
    ("temperature", 95.0, 100.4, "Temp"),
)

DATE_PATTERN = r"^\d{4}-\d{2}-\d{2}$"
PAID = "PAID"
CANCELLED_ORDER = "cancelled"
UNKNOWN = "UNKNOWN"
NO_PAYMENT = "NO PAYMENT"

BOOK, CANCEL = "BOOK", "CANCEL"
BOOKED, CANCELLED = "BOOKED", "CANCELLED"

SPIKE_MIN_COUNT, SPIKE_GROWTH = 8, 2.0
REPEAT_LIMIT = 3
BURST_LIMIT = 5
BIG_AMOUNT = 50000.0
CANCEL_LIMIT = 3
WINDOW_SIZE, WINDOW_SLIDE = "30 seconds", "10 seconds"
TUMBLING_SIZE, WATERMARK = "30 seconds", "1 minute"
# --- end of fixed values ----------------------------------------------------

# Customer tiers have no published limits; these defaults are our own choice.
TIER_BANDS = ((1000000, "GOLD"), (250000, "SILVER"))
TIER_DEFAULT = "BRONZE"
