"""The models of the pipeline, built over the roles."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from callpay.plans import marts
from callpay.plans.intermediate import attribute_payments, code_calls, summarise_payments
from callpay.plans.staging import stage_agents, stage_calls, stage_dispositions, stage_fx, stage_payments
from callpay.sources.contracts import country_seed
from catalogue import roles


class Models:
    """Each attribute is the lazy DataFrame of one model."""

    def __init__(self, spark: SparkSession, sf_dir: str, seed: DataFrame | None = None):
        self.spark, self.sf_dir = spark, sf_dir
        self.seed = seed if seed is not None else country_seed(spark)

    @cached_property
    def calls(self) -> DataFrame:
        return stage_calls(roles.raw_calls(self.spark, self.sf_dir), self.seed)

    @cached_property
    def dispositions(self) -> DataFrame:
        return stage_dispositions(roles.raw_dispositions(self.spark, self.sf_dir), self.seed)

    def payments(self, **options) -> DataFrame:
        return stage_payments(roles.raw_payments(self.spark, self.sf_dir), self.seed, **options)

    @cached_property
    def agents(self) -> DataFrame:
        return stage_agents(roles.raw_agents(self.spark, self.sf_dir))

    @cached_property
    def fx(self) -> DataFrame:
        return stage_fx(roles.raw_fx(self.spark, self.sf_dir))

    @cached_property
    def coded(self) -> DataFrame:
        return code_calls(self.calls, self.dispositions)

    def attribution(self, **options) -> DataFrame:
        return attribute_payments(self.payments(), self.dispositions, self.fx, **options)

    @cached_property
    def summary(self) -> DataFrame:
        return summarise_payments(self.attribution())

    @cached_property
    def coding(self) -> DataFrame:
        return marts.coding_rate(self.coded, self.agents)

    @cached_property
    def paid(self) -> DataFrame:
        return marts.paid_post_call(self.dispositions, self.summary, as_of=roles.AS_OF)

    @cached_property
    def inbound(self) -> DataFrame:
        return marts.inbound_drivers(self.dispositions)

    def daily(self, null_safe: bool = False) -> DataFrame:
        return marts.daily_summary(self.coding, self.paid, self.inbound, null_safe)
