"""All registered queries."""

from factorspark.plans import data_plans, market_plans, research_plans, source_plans, stock_plans, stream_plans  # noqa: F401
from factorspark.plans import registry
from factorspark.plans.ctes import compose

QUERIES = registry.QUERIES
ORACLES = {name: compose(sql) for name, sql in registry.ORACLES.items()}
