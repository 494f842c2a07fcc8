"""Profiling, splitting, preparation, modelling and diagnostic operators."""
