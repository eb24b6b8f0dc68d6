"""Importing this module registers every query."""

from scorewright.plans import q_features, q_ingest, q_models, q_training  # noqa: F401
