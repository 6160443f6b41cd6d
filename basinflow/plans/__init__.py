"""Whole runs and the request engine, composed of operators."""
