"""Layered-table diagnostics on Spark: why do numbers stop matching between the layers of a data flow?"""

from strataudit.config import AuditConfig, TableContract, loan_config
from strataudit.operators.layers import build_layers
from strataudit.operators.profile import profile_layers, profile_tables
from strataudit.plans.diagnosis import DataQualityError, Diagnosis, diagnose, evaluate, quality_gate
from strataudit.plans.reports import render_reports
from strataudit.plans.runs import Runs
from strataudit.sources.history import History
from strataudit.sources.layers import LayerStore

__all__ = ["AuditConfig", "DataQualityError", "Diagnosis", "History", "LayerStore", "Runs", "TableContract",
           "build_layers", "diagnose", "evaluate", "loan_config", "profile_layers", "profile_tables", "quality_gate",
           "render_reports"]
