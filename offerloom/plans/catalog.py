"""Imports every plan module, which fills the registry."""

import importlib

from offerloom.plans.registry import ORACLES, QUERIES

MODULES = ("sources_sinks", "projections", "filters", "joins", "aggregations", "rankings_sets",
           "text_functions", "star", "mining",
           "streams")
for _name in MODULES:
    importlib.import_module(f"offerloom.plans.{_name}")

__all__ = ["QUERIES", "ORACLES"]
