"""The lending layers derived from the benchmark tables, and the queries registered over them."""
