"""Registered queries (Spark callable + oracle SQL per key)."""

from __future__ import annotations

import importlib

_MODULES = ["q_prep", "q_linear", "q_classify", "q_anomaly", "q_cluster", "q_text", "q_recsvm", "q_network", "q_select"]


def registry():
    from keelson.plans.base import REGISTRY
    for m in _MODULES:
        importlib.import_module(f"keelson.plans.{m}")
    return REGISTRY
