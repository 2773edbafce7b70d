"""loamstack: a Spark-first engine for curating training data and analysing telemetry."""
