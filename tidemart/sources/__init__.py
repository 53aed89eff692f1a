"""Sources: change feeds, Kafka/file streams, JDBC, dimension tables, weight files."""
