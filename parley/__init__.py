"""parley: Spark-native analytics for recorded conversations.

Operators are plain ``(DataFrame, params) -> DataFrame`` functions built on
the public DataFrame / SQL API.  Nothing in the library calls an action
except the sinks in :mod:`parley.sinks`.
"""

__version__ = "0.1.0"


def _ship_by_value() -> None:
    """Python steps (``mapInPandas``) are pickled with their code, so
    executors need not have this package installed."""
    try:
        import sys

        from pyspark import cloudpickle

        cloudpickle.register_pickle_by_value(sys.modules[__name__])
    except Exception:  # pragma: no cover - older pickler: rely on PYTHONPATH
        pass


_ship_by_value()
