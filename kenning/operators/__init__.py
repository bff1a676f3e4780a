"""DataFrame -> DataFrame operators. Each takes and returns DataFrames and names its
key and order columns; none collects data to the driver."""
