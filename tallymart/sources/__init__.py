"""Where rows come from and go to: Parquet tables, Kafka, JDBC, CSV."""
