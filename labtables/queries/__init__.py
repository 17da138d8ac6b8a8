"""All registered queries; importing the modules fills the two dictionaries."""

import sys

from pyspark import cloudpickle

from labtables.queries import builds, documents, files, ledgers, pages, parsing, relational, series, splits, stores
from labtables.queries.base import ORACLES, QUERIES

# the Python functions given to operators travel with the job; executors need not have this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["ORACLES", "QUERIES", "builds", "documents", "files", "ledgers", "pages", "parsing", "relational", "series", "splits", "stores"]
