"""Recommended preparation steps per dataset, as rules over signals."""
