"""Speech-corpus preparation on Spark: Column functions, DataFrame operators, sources, plans."""
