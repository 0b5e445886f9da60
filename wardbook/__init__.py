"""Periodic facility reporting on Spark: parameterised DataFrame operators and one batch job."""
