"""Analytics over collections of scientific and web documents, on Spark DataFrames."""
