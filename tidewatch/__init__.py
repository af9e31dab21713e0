"""Security event analytics on Spark: normalise, match, hunt, count, locate, route and report."""
