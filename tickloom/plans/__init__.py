"""Staging, intermediate and mart models, dashboards and the daily job."""
