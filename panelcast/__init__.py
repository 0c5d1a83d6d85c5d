"""panelcast: hourly panel analytics and pooled forecasting on Spark DataFrames."""
