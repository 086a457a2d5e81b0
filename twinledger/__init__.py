"""Two-sided table reconciliation on Spark.

Every operator takes DataFrames and returns a DataFrame.  ``plans.ladders`` strings them
together into the three ladders (models, warehouse views, CSV extracts).
"""
