"""Land-parcel and gridded-indicator analytics on Spark DataFrames."""
