"""Reading and writing: files, databases, Kafka and the day tables."""
