"""wayfact: trip and condition analytics written directly on Spark DataFrames."""
