"""Tidewater: a PySpark-native, lineage-aware data layer and analytics engine."""
