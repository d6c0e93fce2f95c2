"""Compositions of operators: layouts, reports, health, the detector as a whole."""
