"""rollspan: subscriber feature, data-quality and scoring operators on Spark DataFrames."""
