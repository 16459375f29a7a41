"""Relational building blocks: merge, filters, paging, facets, neighbours."""
