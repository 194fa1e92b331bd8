"""Period loads, record chains and reports as Spark jobs."""
