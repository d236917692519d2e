"""Relational operators: projections, filters, joins, aggregates, order-dependent ones and sets."""
