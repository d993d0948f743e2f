"""tessera: entity-period panel features on Spark.

Every public operator is a function ``DataFrame -> DataFrame`` built from
Spark SQL expressions, window frames, joins and Spark ML.  Chain them with
``DataFrame.transform``.
"""

from tessera.session import get_session, scratch_dir

__all__ = ["get_session", "scratch_dir"]
