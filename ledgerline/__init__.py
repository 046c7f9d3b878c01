"""Subscription-revenue analytics as plain Spark DataFrame functions."""
