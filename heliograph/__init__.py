"""heliograph: a PySpark-native analytics engine for paired expression / accessibility data."""
