"""Cohort and follow-up reports over clinical-record tables, on Spark."""

from carelens.params import ReportParams
from carelens.sources.tables import ClinicalTables, JdbcSource, load_tables, store_tables

__all__ = ["ReportParams", "ClinicalTables", "JdbcSource", "load_tables", "store_tables"]
