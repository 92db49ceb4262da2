"""tiffin — delivery-marketplace analytics as Spark DataFrame plans.

Layers:
  sources    raw inputs: typed readers, the test-fixture mapping, seed tables, sinks
  functions  column helpers with the warehouse-dialect semantics the models need
  operators  the analytic sub-operators (pricing, SLA, funnel, RFM, ranks, checks ...)
  plans      staging models and marts composed from the operators
"""

from tiffin.session import local_session

__all__ = ["local_session"]
