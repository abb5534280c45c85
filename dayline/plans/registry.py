"""All plans by name: ``(callable(spark, sf_dir) -> DataFrame, SQL or None)``."""

from __future__ import annotations

import importlib

from dayline.session import configure

MODULES = ("text_plans", "clean_plans", "memory_plans", "report_plans", "audit_plans", "runlog_plans", "source_plans")


def plans() -> dict:
    out = {}
    for name in MODULES:
        out.update(importlib.import_module(f"dayline.plans.{name}").PLANS)
    return out


def _prepared(plan):
    def run(spark, sf_dir):
        return plan(configure(spark), sf_dir)

    return run


def queries() -> dict:
    return {name: _prepared(plan) for name, (plan, _) in plans().items()}


def oracle_sql() -> dict:
    return {name: sql for name, (_, sql) in plans().items() if sql}
