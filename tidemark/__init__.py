"""Keep analytical tables in step with their sources, and judge the result, on Spark."""
