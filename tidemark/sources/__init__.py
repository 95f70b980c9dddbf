"""Reading sources, stage tables, published tables and logs."""
