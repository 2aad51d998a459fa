"""Every operator as a query over the test tables, with SQL to check it."""

from tarnish.queries import cleaning, errors, generated, inout, pairs, relational
from tarnish.queries.pairs import flagship
from tarnish.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "cleaning", "errors", "flagship", "generated", "inout", "pairs", "relational"]
