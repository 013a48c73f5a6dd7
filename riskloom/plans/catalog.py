"""Imports every catalogue module so their queries register themselves."""

from __future__ import annotations

import importlib

from riskloom.plans.registry import ORACLE, QUERIES

_MODULES = (
    "riskloom.plans.cohort_catalog",
    "riskloom.plans.metric_catalog",
    "riskloom.plans.split_catalog",
    "riskloom.plans.feature_catalog",
    "riskloom.plans.scoring_catalog",
    "riskloom.plans.stats_catalog",
    "riskloom.plans.leaderboard_catalog",
    "riskloom.plans.bootstrap_catalog",
    "riskloom.plans.docs_catalog",
    "riskloom.plans.model_catalog",
    "riskloom.plans.model_extra_catalog",
    "riskloom.plans.streaming_catalog",
    "riskloom.plans.source_catalog",
)

for _m in _MODULES:
    importlib.import_module(_m)


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLE)
