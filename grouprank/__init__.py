"""grouprank: group-aware similarity analytics as Spark DataFrame plans.

Vocabulary: an *item* belongs to a *group* and has an *entity* (the relevance
label); items carry numeric *features* and optionally a *text*. Every public
function takes and returns DataFrames and never pulls rows to the driver.
"""

from grouprank.params import FEATURES, Params

__all__ = ["FEATURES", "Params"]
