"""Spark-native engine for fill-in-the-middle corpora and completion scoring.

The package is a set of DataFrame transformations.  ``functions`` holds Column
builders that never shuffle, ``operators`` holds DataFrame-to-DataFrame steps,
``plans`` strings the steps into stages, ``sources`` and ``sinks`` read and
write tables, ``streaming`` runs the stateless part incrementally.
"""

from gapweave.params import (
    EvalParams,
    FeedParams,
    FimParams,
    Markers,
    SplitParams,
)

__all__ = ["EvalParams", "FeedParams", "FimParams", "Markers", "SplitParams"]
