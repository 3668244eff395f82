"""martkit: trusted data marts and a price model, built from Spark DataFrame operators.

Layers:

* ``martkit.sources``   — table scans, contract scans, CSV export/import, snapshot publish.
* ``martkit.functions`` — column expressions (clamps, fences, defaults, coercion).
* ``martkit.operators`` — relational operators: statistics, gates, raw/clean marts,
  profiling, split, features, model.
* ``martkit.plans``     — the end-to-end pipeline and plan-inspection helpers.
* ``martkit.streaming`` — intentionally empty (the modelled pipeline is batch only).
"""

from martkit.contract import EXPORT_COLUMNS, HOUSING, MartSpec
from martkit.errors import ContractError, GateError

__all__ = ["EXPORT_COLUMNS", "HOUSING", "MartSpec", "ContractError", "GateError"]
