"""Composite reporting jobs built from the operators, plus the query
catalogue (``catalogue``) that exercises them on the driver tables."""
