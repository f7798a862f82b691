"""tessera: text-corpus analytics on Spark.

Every operator is either ``Column -> Column`` (``tessera.functions``) or
``DataFrame -> DataFrame`` (``tessera.operators``).  Readers and writers live in
``tessera.sources``, streaming jobs in ``tessera.streaming`` and the bindings of
operators onto the driver tables in ``tessera.plans``.
"""

from tessera.session import checkpoint_dir, get_session

__all__ = ["get_session", "checkpoint_dir"]
