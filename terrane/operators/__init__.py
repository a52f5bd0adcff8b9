"""DataFrame-to-DataFrame operators: cleansing, rules, joins, profiling, learning, upkeep."""
