"""Every operator as a query over the given tables, with the SQL that states its result."""

from plumbline.gallery import batch, grouped, pairs, profiles, rulesets, scan, sources

_MODULES = (scan, grouped, pairs, rulesets, profiles, sources, batch)

QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
ORACLES = {name: sql for module in _MODULES for name, sql in module.ORACLES.items()}
