"""Entity resolution and master data on Spark: match, link, resolve, keep history."""
