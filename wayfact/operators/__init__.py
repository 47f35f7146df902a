"""DataFrame operators: cleaning, joins, dimensions, preparation, demand, models."""
