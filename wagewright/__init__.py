"""Payroll and warehouse analytics expressed as Spark DataFrame jobs."""
