"""The queries by name, and the SQL that they are held against."""

from . import assembly, checks, files, modelling, reconcile, reporting, validation  # noqa: F401
from .common import ORACLES, QUERIES

FLAGSHIP = "monthly_auc_ks"

__all__ = ["FLAGSHIP", "ORACLES", "QUERIES"]
