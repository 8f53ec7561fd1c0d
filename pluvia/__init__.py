"""pluvia: climate and sensor-reading analytics on PySpark DataFrames."""
