"""Composite builders (dimensions, facts, silver loads) and the catalogue
binding the operators to the driver's tables."""
