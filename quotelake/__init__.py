"""Daily market-data lakehouse operators written on the Spark DataFrame API."""
