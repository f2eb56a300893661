"""chainlens: block, transaction and rollup analytics as Spark DataFrame transforms.

Every public transform is ``DataFrame -> DataFrame`` and free of actions, so it
composes with ``df.transform`` and leaves planning to Catalyst.
"""

from chainlens.session import get_spark, tune_session

__all__ = ["get_spark", "tune_session"]
