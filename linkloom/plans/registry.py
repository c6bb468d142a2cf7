"""All core queries by name, with the SQL of those that SQL can express."""

from . import graph, problems

QUERIES = {**graph.QUERIES, **problems.QUERIES}
ORACLES = {**graph.ORACLES, **problems.ORACLES}
