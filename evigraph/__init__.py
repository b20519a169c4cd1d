"""Evidence-backed property graphs and corpus tables, assembled with Spark DataFrames."""
