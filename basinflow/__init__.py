"""basinflow: a PySpark-native engine for gridded hydro-climate ensembles."""
