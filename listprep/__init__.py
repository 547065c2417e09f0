"""listprep: list building, record extraction and fetch planning on Spark DataFrames."""
