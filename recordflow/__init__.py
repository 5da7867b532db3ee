"""recordflow: DataFrame operators for customer-record and account-reporting work on Spark."""

__version__ = "0.1.0"
