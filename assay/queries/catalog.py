"""Imports every query module so that its queries register."""

from assay.queries import findings, modelling, profile, scores, study  # noqa: F401
