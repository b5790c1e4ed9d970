"""Queries over the project's tables, each with its SQL where SQL can express it."""

MODULES = [f"vellumine.plans.{name}" for name in ("nested", "texts", "records", "evaluation")]
