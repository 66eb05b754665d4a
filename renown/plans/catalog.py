"""Imports every query module so the registry is complete."""

from renown.plans import (q_dedup, q_enrich, q_filters, q_functions, q_normalize, q_pipeline,  # noqa: F401
                          q_run, q_sources, q_streaming, q_summary, q_talk)
from renown.plans.registry import ORACLES, QUERIES  # noqa: F401
