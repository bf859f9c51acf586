"""titlespan: product-listing titles to structured attributes, as Spark DataFrames."""
