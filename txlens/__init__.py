"""txlens: unsupervised analytics over payment transactions on Spark.

Every public operator is a plain ``DataFrame -> DataFrame`` function (or a
small fitted-model object whose outputs are DataFrames), built from Spark SQL
expressions and ``pyspark.ml``. Python on executors is used only where Spark
has no operator: growing / scoring the isolation forest and TreeSHAP.
"""

from txlens.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
