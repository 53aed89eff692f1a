"""DataFrame -> DataFrame operators (projections, routing, joins, windows, keyed state, scoring)."""
