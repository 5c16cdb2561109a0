"""Transport punctuality analytics on Spark: landing -> bronze -> silver -> gold."""
