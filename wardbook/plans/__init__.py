"""Operators bound to concrete schemas: the facility job and the driver-table queries."""
