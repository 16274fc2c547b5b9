"""Registered queries over the given tables, with their SQL oracles."""

import importlib

MODULES = ["q_clean", "q_scores", "q_ingest", "q_models", "q_clusters", "q_flows"]


def load_all() -> None:
    for name in MODULES:
        importlib.import_module(f"checks.{name}")
