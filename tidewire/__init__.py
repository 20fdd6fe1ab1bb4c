"""tidewire: a Spark-native engine for batch news intelligence."""
