"""Where records come from and go to: capture files, table files, Kafka topics."""
