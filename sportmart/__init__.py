"""sportmart: a league star schema built from nested JSON, as plain Spark DataFrame plans."""
