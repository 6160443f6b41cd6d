"""Operators on grids, zones and tiles."""
