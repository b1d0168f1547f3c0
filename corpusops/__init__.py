"""corpusops: instruction-data, evaluation, telemetry and cost operators on Spark DataFrames."""
