"""The models of one scale-factor folder, composed lazily for the registered queries."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from tidemark.plans import marts, staging
from tidemark.sources import shop


class Shop:
    """Every model as a lazy DataFrame; a query only plans what it touches."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def raw(self, name: str) -> DataFrame:
        return shop.RAW[name](self.spark, self.sf_dir)

    @cached_property
    def customers(self) -> DataFrame:
        return staging.stg_customers(self.raw("customers"))

    @cached_property
    def products(self) -> DataFrame:
        return staging.stg_products(self.raw("products"))

    @cached_property
    def product_costs(self) -> DataFrame:
        return staging.stg_products(self.raw("products"), ["product_id", "unit_cost"])

    @cached_property
    def signups(self) -> DataFrame:
        return staging.stg_customers(self.raw("customers"), ["customer_id", "signup_date"])

    @cached_property
    def orders(self) -> DataFrame:
        return staging.stg_orders(self.raw("orders"))

    @cached_property
    def items(self) -> DataFrame:
        return staging.stg_order_items(self.raw("order_items"))

    @cached_property
    def events(self) -> DataFrame:
        return staging.stg_web_events(self.raw("web_events"))

    @cached_property
    def history(self) -> DataFrame:
        return marts.dim_customers_history(staging.stg_customer_versions(self.raw("customers")))

    @cached_property
    def order_money(self) -> DataFrame:
        """The order fact without its as-of columns, for consumers that do not read them."""
        return marts.order_money(self.orders, self.items, self.product_costs)

    @cached_property
    def fct_orders(self) -> DataFrame:
        return marts.fct_orders(self.orders, self.items, self.product_costs, self.history)

    @cached_property
    def fct_order_items(self) -> DataFrame:
        return marts.fct_order_items(self.items, self.fct_orders, self.products)

    @cached_property
    def daily_channel(self) -> DataFrame:
        return marts.mart_daily_channel(self.order_money)

    @cached_property
    def funnel(self) -> DataFrame:
        return marts.mart_funnel_daily(self.events)

    @cached_property
    def retention(self) -> DataFrame:
        return marts.mart_cohort_retention(self.signups, self.order_money)

    @cached_property
    def rfm(self) -> DataFrame:
        return marts.mart_customer_rfm(self.order_money)
