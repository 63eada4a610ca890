"""Record completion on Spark: lazy DataFrame operators, built-in expressions only."""
