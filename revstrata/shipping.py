"""Functions that run inside tasks are sent by value, so that workers need no path to this repository."""

from __future__ import annotations

import sys

from pyspark import cloudpickle


def ship(module: str) -> None:
    """Send the functions of a module to the executors by value; for the end of the module."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


ship(__name__)
