"""lotwise: vehicle-retail sales, inventory and market-share reporting on Spark DataFrames."""
