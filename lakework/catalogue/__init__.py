"""Registered queries over the given tables, each with the SQL it must agree with."""

from lakework.catalogue import files, jobs, nested, reports, streams, tables
from lakework.catalogue.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "files", "jobs", "nested", "reports", "streams", "tables"]
