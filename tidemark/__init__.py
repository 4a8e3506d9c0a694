"""tidemark: a daily entity-by-date panel pipeline on Spark DataFrames.

Bronze (raw panel) -> Silver (cleaned, derived rates) -> Gold (star schema) -> analytic
queries, dashboard marts, profiling, data-quality gate and an arrival audit, in batch or with
Structured Streaming.  Every stage is a lazy DataFrame transform parameterised by
``tidemark.config.PanelConfig``.
"""

from tidemark.config import PanelConfig, Rule, default_rules

__all__ = ["PanelConfig", "Rule", "default_rules"]
