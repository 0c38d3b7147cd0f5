"""threadloom: customer-support conversation analytics on Spark DataFrames."""
