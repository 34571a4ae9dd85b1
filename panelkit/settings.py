"""Default parameters. Every operator takes its own as arguments."""

SERIES_KEY = ("store_id", "item_id")
SERIES_ATTRIBUTES = ("dept_id", "cat_id", "state_id")
ORDER = "day_num"
VALUE = "sales"
PRICE = "sell_price"

# Periods, in days, that the model features are defined on.
LAGS = (1, 7, 14, 28, 56)
WINDOWS = (7, 14, 28, 56)
PRICE_WINDOWS = (7, 28)
HISTORY_DAYS = 500
VALIDATION_DAYS = 28
HORIZON_DAYS = 28

SAMPLE_ITEMS = 100
SAMPLE_MINIMUM = 5
SEED = 42

# Event categories with a feature of their own.
EVENT_TYPES = ("Religious", "National", "Cultural", "Sporting", "Federal")
NO_EVENT = "None"
NEVER_SOLD_DAYS = 999

ENCODED = ("store_id", "item_id", "dept_id", "cat_id", "state_id", "weekday")

RAW_FEATURES = (
    "day_num", "wm_yr_wk", "wday", "month", "year",
    "snap_CA", "snap_TX", "snap_WI", "sell_price",
)
CALENDAR_FEATURES = (
    "day_of_month", "day_of_year", "week_of_year", "quarter",
    "is_weekend", "is_month_start", "is_month_end",
    "month_sin", "month_cos", "wday_sin", "wday_cos",
    "has_event1", "has_event2", "has_any_event",
) + tuple(f"event_{e.lower()}" for e in EVENT_TYPES)
LAG_FEATURES = tuple(f"sales_lag_{n}" for n in LAGS)
ROLLING_FEATURES = tuple(
    f"sales_r{n}_{s}" for n in WINDOWS for s in ("mean", "std", "min", "max", "median")
) + ("sales_expanding_mean",)
PRICE_FEATURES = (
    ("price_change", "price_change_pct")
    + tuple(f"price_r{n}_{s}" for n in PRICE_WINDOWS for s in ("mean", "std"))
    + ("discount", "price_momentum")
)
BUSINESS_FEATURES = tuple(f"{c}_enc" for c in ENCODED) + (
    "store_avg_sales", "cat_avg_sales", "item_avg_sales",
    "sales_vs_store_avg", "sales_vs_cat_avg", "zero_streak", "days_since_sale",
)
INTERACTION_FEATURES = ("price_x_event", "weekend_x_lag7", "snap", "snap_x_price", "trend_7_28")

FEATURE_COLUMNS = (
    RAW_FEATURES + CALENDAR_FEATURES + LAG_FEATURES + ROLLING_FEATURES
    + PRICE_FEATURES + BUSINESS_FEATURES + INTERACTION_FEATURES
)

# Columns computed from the same day's sales: a model that sees them has been told the answer.
LEAKY_FEATURES = ("sales_vs_store_avg", "sales_vs_cat_avg", "days_since_sale")

NON_FEATURES = ("sales", "store_id", "item_id", "dept_id", "cat_id", "state_id")
DROPPED_COLUMNS = (
    "id", "date", "event_name_1", "event_type_1", "event_name_2", "event_type_2", "weekday",
)
