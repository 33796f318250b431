"""Fixed values.

These must equal the values the original pipeline uses, otherwise results
differ.  They are stated plainly, together, in their natural order.
"""

# --- Fixed values: cleaning ---------------------------------------------------
# Email must match this pattern (checked before trimming).
EMAIL_PATTERN = r"^[\w\.-]+@[\w\.-]+\.\w+$"
# Inclusive age range kept by the users cleaner.
AGE_MIN = 0
AGE_MAX = 120
# Transaction statuses kept by the transactions cleaner.
VALID_STATUSES = ("completed", "pending", "failed")
# Log levels kept by the logs cleaner (case sensitive).
VALID_LEVELS = ("INFO", "WARNING", "ERROR", "DEBUG")

# --- Fixed values: enrichment -------------------------------------------------
# Domain part of an email address.
EMAIL_DOMAIN_PATTERN = r"@([\w\.-]+)"
# age_group: below 25 young, below 50 adult, otherwise senior.
AGE_GROUP_BOUNDS = ((25, "young"), (50, "adult"))
AGE_GROUP_OTHER = "senior"
# Currency -> EUR multiplier; any other currency (or null) passes unchanged.
EUR_RATES = {"USD": 0.92, "GBP": 1.17}
# amount_category on the raw amount: below 50 small, below 500 medium, else large.
AMOUNT_CATEGORY_BOUNDS = ((50, "small"), (500, "medium"))
AMOUNT_CATEGORY_OTHER = "large"
# severity_level: ERROR 3, WARNING 2, anything else 1.
SEVERITY_LEVELS = (("ERROR", 3), ("WARNING", 2))
SEVERITY_OTHER = 1

# --- Fixed values: layout -----------------------------------------------------
# Partition columns of PROCESSED outputs by dataset type.
PARTITION_COLUMNS = {
    "transactions": ("transaction_year", "transaction_month"),
    "logs": ("log_date",),
}
# Curated schemas created by the warehouse step.
WAREHOUSE_SCHEMAS = ("curated", "staging", "analytics")
# Rows per batch when the curated load goes to a JDBC database.
JDBC_BATCH_SIZE = 10000

# --- Fixed values: streaming --------------------------------------------------
# Tumbling window of the merchant stream aggregate, and its trigger.
STREAM_WINDOW = "1 minute"
STREAM_TRIGGER = "10 seconds"
# Only completed transactions enter the stream aggregate.
STREAM_STATUS = "completed"
# Bounded pull of the hourly Kafka ingest.
KAFKA_HOURLY_MAX_MESSAGES = 10000
# Payload of a transaction message: field and type.
TRANSACTION_FIELDS = (
    ("transaction_id", "string"),
    ("user_id", "string"),
    ("amount", "float"),
    ("currency", "string"),
    ("timestamp", "timestamp"),
    ("merchant", "string"),
    ("status", "string"),
)

# --- Fixed values: data-quality alerts ----------------------------------------
# Validation-error rate alert: rate over 5 minutes above 0.1 per second,
# held for 5 minutes, evaluated every 60 seconds.
ERROR_RATE_RANGE = "5 minutes"
ERROR_RATE_RANGE_SECONDS = 300
ERROR_RATE_EVAL = "1 minute"
ERROR_RATE_THRESHOLD = 0.1
ERROR_RATE_HOLD_MINUTES = 5
# Failing data tests alert: any failing test, held 1 minute.
TEST_FAILURE_THRESHOLD = 0
TEST_FAILURE_HOLD_MINUTES = 1

# --- Model tests (model, column, test) ----------------------------------------
MODEL_TESTS = (
    ("dim_users", "user_id", "unique"),
    ("dim_users", "user_id", "not_null"),
    ("dim_users", "email", "not_null"),
    ("fact_transactions", "transaction_id", "unique"),
    ("fact_transactions", "transaction_id", "not_null"),
    ("fact_transactions", "user_id", "not_null"),
    ("fact_transactions", "user_id", "relationships"),
)
# relationships target: fact_transactions.user_id -> dim_users.user_id
RELATIONSHIP_TARGET = ("dim_users", "user_id")
