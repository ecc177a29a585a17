"""txnlake: card-transaction risk analytics on PySpark.

Bronze -> Silver -> Gold feature layers, incremental scoring with an
idempotent predictions sink, Spark ML training/scoring, alerting, and the
monitoring / validation reports, all as DataFrame -> DataFrame functions.
"""

__version__ = "0.1.0"
