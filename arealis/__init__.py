"""Area statistics on Spark: find areas, fetch their variables, carry margins of error."""
