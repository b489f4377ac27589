"""Stock ledger and order fulfilment analytics on Spark DataFrames."""
