"""Every registered query. Importing the modules fills the registry."""

from granero.suite import feeds, vocabulary, files, fulfilment, catalogue, planning  # noqa: F401
from granero.suite import promotions, market, finance, people  # noqa: F401
from granero.suite.registry import QUERIES, oracle_text, run

__all__ = ["QUERIES", "oracle_text", "run"]
