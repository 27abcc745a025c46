"""The declared data tests: generic ones per column, and the business rules."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame

from tidemark.operators.assertions import DataTest, is_not_accepted, is_null, not_unique, orphans, row_test
from tidemark.plans import checks
from tidemark.specs import EVENT_TYPES, FUNNEL_STAGES, ORDER_STATUSES, RFM_SEGMENTS

# Declared tests by model and column.
UNIQUE = (
    ("stg_customers", "customer_id"),
    ("stg_products", "product_id"),
    ("stg_orders", "order_id"),
    ("stg_order_items", "order_item_id"),
    ("stg_web_events", "event_id"),
    ("dim_customers", "customer_id"),
    ("dim_products", "product_id"),
    ("fct_orders", "order_id"),
    ("fct_order_items", "order_item_id"),
    ("mart_funnel_daily", "funnel_key"),
    ("mart_customer_rfm", "customer_id"),
)
NOT_NULL = UNIQUE + (
    ("stg_orders", "customer_id"),
    ("stg_orders", "channel"),
    ("dim_customers_history", "customer_id"),
    ("dim_customers_history", "valid_from"),
    ("dim_customers_history", "valid_to"),
    ("fct_orders", "customer_id"),
    ("fct_orders", "country"),
    ("mart_daily_channel", "order_date"),
    ("mart_daily_channel", "channel"),
)
ACCEPTED_VALUES = (
    ("stg_orders", "status", ORDER_STATUSES),
    ("stg_web_events", "event_type", EVENT_TYPES),
    ("fct_orders", "status", ORDER_STATUSES),
    ("mart_funnel_daily", "stage", FUNNEL_STAGES),
    ("mart_customer_rfm", "rfm_segment", RFM_SEGMENTS),
)
RELATIONSHIPS = (
    ("stg_orders", "customer_id", "stg_customers", "customer_id"),
    ("stg_order_items", "order_id", "stg_orders", "order_id"),
    ("stg_order_items", "product_id", "stg_products", "product_id"),
    ("fct_orders", "customer_id", "dim_customers", "customer_id"),
)


def row_conditions() -> dict[str, dict[str, Column]]:
    """The tests of single rows: by model, label and the condition that breaks the rule."""
    listed = [(t, f"not_null {t}.{c}", is_null(c)) for t, c in NOT_NULL]
    listed += [(t, f"accepted_values {t}.{c}", is_not_accepted(c, v)) for t, c, v in ACCEPTED_VALUES]
    listed += [
        ("stg_order_items", "no_negative_amounts", checks.is_negative_amount()),
        ("mart_cohort_retention", "retention_is_a_rate", checks.is_not_a_rate()),
    ]
    by_model: dict[str, dict[str, Column]] = {}
    for model, label, broken in listed:
        by_model.setdefault(model, {})[label] = broken
    return by_model


def generic_tests(m: Mapping[str, DataFrame]) -> list[DataTest]:
    return [DataTest(f"unique {t}.{c}", not_unique(m[t], c)) for t, c in UNIQUE] + [
        DataTest(f"relationships {t}.{c}", orphans(m[t], c, m[p], pc)) for t, c, p, pc in RELATIONSHIPS
    ]


def rule_tests(m: Mapping[str, DataFrame]) -> list[DataTest]:
    return [
        DataTest("order_totals_reconcile", checks.totals_off(m["fct_orders"], m["fct_order_items"])),
        DataTest("daily_channel_matches_orders", checks.daily_channel_off(m["mart_daily_channel"], m["fct_orders"])),
        DataTest("funnel_matches_events", checks.funnel_off(m["stg_web_events"], m["mart_funnel_daily"])),
        DataTest(
            "fct_orders_is_complete",
            checks.orders_incomplete(m["stg_orders"], m["stg_order_items"], m["fct_orders"]),
        ),
        DataTest("scd2_is_contiguous", checks.history_broken(m["dim_customers_history"])),
    ]


def declared_tests(models: Mapping[str, DataFrame], observed: Mapping[str, int] | None = None) -> list[DataTest]:
    """All tests over the models; ``observed`` are violations by label that the build has counted."""
    seen = observed or {}
    rows = [
        row_test(label, models[model], broken, observed=seen.get(label))
        for model, tests in row_conditions().items()
        for label, broken in tests.items()
    ]
    return generic_tests(models) + rows + rule_tests(models)
