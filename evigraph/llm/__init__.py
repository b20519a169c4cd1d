"""Operators on training corpora; nothing outside this subpackage imports it."""

from __future__ import annotations

import sys

from pyspark import cloudpickle

# Executors need no copy of this package: what Python workers run is sent along with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def queries() -> dict:
    from . import catalog

    return catalog.QUERIES


def oracle_sql() -> dict[str, str]:
    from . import catalog

    return catalog.ORACLE_SQL
