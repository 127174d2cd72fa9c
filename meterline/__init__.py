"""Trip-style fact tables on Spark: sources, operators, table loads, checks and reports."""
