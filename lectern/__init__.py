"""lectern: document analytics declared on Spark DataFrames."""
