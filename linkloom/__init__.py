"""Link-dump aggregation as Spark DataFrame operators."""
