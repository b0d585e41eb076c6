"""Tallyloom: a PySpark engine that keeps register and document warehouses correct."""
