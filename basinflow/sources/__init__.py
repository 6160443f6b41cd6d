"""Readers: grids, catalogues, metadata, zones and array bundles."""
