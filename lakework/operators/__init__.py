"""Relational operators: joins, aggregates, top-k, unions, filters, flattening."""
