"""Operators: relational helpers, splitting, feature stages, estimators, model tables, evaluators."""

from tabml.operators import evaluate, features, inspect, models, relational, split  # noqa: F401
