"""Bronze-shaped views over the benchmark tables, the registered queries and their SQL oracle."""
