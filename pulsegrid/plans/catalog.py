"""All registered queries (importing the query modules registers them)."""

from __future__ import annotations

from pulsegrid.plans import q_flagship, q_io, q_models, q_prep, q_protocols, q_signal, q_stats  # noqa: F401
from pulsegrid.plans.registry import ORACLES, QUERIES


def flagship(spark, sf_dir):
    return QUERIES["flagship_window_model"](spark, sf_dir)


__all__ = ["QUERIES", "ORACLES", "flagship"]
