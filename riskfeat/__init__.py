"""riskfeat: behavioural risk features over event logs, written for Spark.

Every operator is a function ``(DataFrame, column names, parameters) ->
DataFrame`` built from DataFrame / window / Spark ML primitives, so Catalyst
plans it and the work spreads over the cluster. Sub-packages:

* ``sources``   - readers (CSV with a declared schema, Parquet fixtures) and sinks
* ``functions`` - column expressions: time parts, statistics, safe ratios, tokens
* ``operators`` - feature blocks keyed by the entity column (``user``)
* ``plans``     - assembled jobs: the feature table, encoding and scoring
* ``streaming`` - the time-part parsing on a streaming source
"""

__version__ = "0.1.0"
