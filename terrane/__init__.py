"""Spec-driven, layered lakehouse jobs written as plain PySpark DataFrame work."""

from terrane.plans.job import run
from terrane.plans.spec import JobSpec, load_spec

__all__ = ["JobSpec", "load_spec", "run"]
