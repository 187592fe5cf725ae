"""Loan-level credit-risk analytics as Spark DataFrame jobs."""
