"""PySpark operators and jobs for customer-messaging data."""
