"""ringfold: a PySpark-native engine for token-ring tables, telemetry and mutation logs."""
