"""Incremental delivery of the batch landing step.

The reference is one-shot batch (SURVEY §2.9: no stream operator exists), so
nothing here adds semantics: ``land_stream`` runs the same envelope gate and
bronze landing (SRC-1, SRC-2, SINK-1) on envelope files as they arrive.
"""

from strata.streaming.landing import land_stream

__all__ = ["land_stream"]
