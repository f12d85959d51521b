"""Star-schema loading, reconciliation and reporting on Spark DataFrames."""
