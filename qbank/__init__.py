"""qbank: Spark-native operators for building and evaluating textbook question banks."""

import sys

__version__ = "0.1.0"


def _ship_code_by_value() -> None:
    """The two Python hops (page parsing, model backends) run in executor
    workers. Registering the package for pickling by value sends the code with
    the task, so executors need no copy of ``qbank`` on their path (a package
    installed on the cluster works as well; this just removes the need)."""
    try:
        from pyspark import cloudpickle
        cloudpickle.register_pickle_by_value(sys.modules[__name__])
    except Exception:  # older cloudpickle: ship the package with --py-files instead
        pass


_ship_code_by_value()
