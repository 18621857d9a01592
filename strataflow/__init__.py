"""strataflow: Spark-native operators for imbalanced tabular classification.

Every operator takes and returns DataFrames and does its work in Spark.
Sub-packages:

* ``sources``   - table loading, stand-in views, ledger / report / split IO
* ``functions`` - column-expression builders (scalar, array, ranking, math)
* ``operators`` - data quality, profiling, sampling, features, models, metrics,
                  statistics, drift, audits, search, explanation, registry
* ``plans``     - the end-to-end pipeline and the registered query catalog
* ``streaming`` - micro-batch application of the batch operators
"""

from strataflow.session import get_spark, checkpoint_dir  # noqa: F401

__version__ = "0.1.0"
