"""Star-schema cleaning, loading and reporting for wide, dirty sales tables on Spark."""
