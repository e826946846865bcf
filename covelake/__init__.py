"""covelake: a Spark engine for medallion insurance analytics and training-corpus preparation."""
