"""One StructType per lake layer, checked on read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

KEY = "trans_num"
PARTITION_COLS = ["transaction_year", "transaction_month"]

# Full source record (ingestion metadata struct excluded: it is dropped before
# any database sink and its inner fields are not specified).
BRONZE = T.StructType(
    [
        T.StructField("trans_date_trans_time", T.StringType()),
        T.StructField("cc_num", T.LongType()),
        T.StructField("merchant", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("amt", T.DecimalType(12, 2)),
        T.StructField("first_name", T.StringType()),
        T.StructField("last_name", T.StringType()),
        T.StructField("gender", T.StringType()),
        T.StructField("street", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("zip", T.StringType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("long", T.DoubleType()),
        T.StructField("city_pop", T.IntegerType()),
        T.StructField("job", T.StringType()),
        T.StructField("dob", T.DateType()),
        T.StructField("trans_num", T.StringType()),
        T.StructField("unix_time", T.LongType()),
        T.StructField("merch_lat", T.DoubleType()),
        T.StructField("merch_long", T.DoubleType()),
        T.StructField("is_fraud", T.IntegerType()),
        T.StructField("ingestion_timestamp", T.TimestampNTZType()),
    ]
)

# Columns Silver adds (trans_date_trans_time becomes a timestamp, amt a double).
SILVER_DERIVED = T.StructType(
    [
        T.StructField("transaction_year", T.IntegerType()),
        T.StructField("transaction_month", T.IntegerType()),
        T.StructField("transaction_day", T.IntegerType()),
        T.StructField("transaction_hour", T.IntegerType()),
        T.StructField("is_weekend", T.IntegerType()),
    ]
)

# Columns Gold adds.
GOLD_DERIVED = T.StructType(
    [
        T.StructField("customer_age", T.LongType()),
        T.StructField("high_amount_flag", T.IntegerType()),
        T.StructField("night_transaction_flag", T.IntegerType()),
        T.StructField("customer_merchant_distance", T.DoubleType()),
    ]
)

# Model inputs, in the order the model was trained on.
# The model's features in their order, and the columns of a prediction.
FEATURES = [
    "amt",
    "city_pop",
    "lat",
    "long",
    "merch_lat",
    "merch_long",
    "unix_time",
    "transaction_hour",
    "is_weekend",
    "customer_age",
    "high_amount_flag",
    "night_transaction_flag",
    "customer_merchant_distance",
]
LABEL = "is_fraud"

PREDICTIONS = T.StructType(
    [
        T.StructField("trans_num", T.StringType()),
        T.StructField("amt", T.DoubleType()),
        T.StructField("city_pop", T.IntegerType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("long", T.DoubleType()),
        T.StructField("merch_lat", T.DoubleType()),
        T.StructField("merch_long", T.DoubleType()),
        T.StructField("unix_time", T.LongType()),
        T.StructField("transaction_hour", T.IntegerType()),
        T.StructField("is_weekend", T.IntegerType()),
        T.StructField("customer_age", T.LongType()),
        T.StructField("high_amount_flag", T.IntegerType()),
        T.StructField("night_transaction_flag", T.IntegerType()),
        T.StructField("customer_merchant_distance", T.DoubleType()),
        T.StructField("fraud_prediction", T.IntegerType()),
        T.StructField("fraud_probability", T.DoubleType()),
        T.StructField("inference_timestamp", T.TimestampNTZType()),
    ]
)

# The persisted table: predictions partitioned by the run that wrote them.
PREDICTIONS_TABLE = T.StructType(PREDICTIONS.fields + [T.StructField("batch_id", T.StringType())])

ALERTS = T.StructType(
    [
        T.StructField("trans_num", T.StringType()),
        T.StructField("amt", T.DoubleType()),
        T.StructField("fraud_probability", T.DoubleType()),
        T.StructField("inference_timestamp", T.TimestampNTZType()),
    ]
)

# Columns each job needs from its input layer (checked when it is read).
SILVER_INPUT = [KEY, "trans_date_trans_time", "amt", "ingestion_timestamp"]
GOLD_INPUT = ["dob", "amt", "transaction_hour", "lat", "long", "merch_lat", "merch_long"]
SCORING_INPUT = [KEY, "ingestion_timestamp", *FEATURES]
TRAINING_INPUT = [KEY, *FEATURES, LABEL]


def check_columns(df: DataFrame, required: list[str] | T.StructType, what: str) -> DataFrame:
    """Fail fast when a layer lacks columns its consumers need."""
    names = required.fieldNames() if isinstance(required, T.StructType) else required
    missing = [c for c in names if c not in df.columns]
    if missing:
        raise ValueError(f"{what}: missing columns {missing}")
    return df
