"""shiftwise: operational reporting operators on Spark DataFrames.

Every operator is a plain function from DataFrames (and column names) to a
lazy DataFrame or Column. Nothing here collects data to the driver; physical
strategy is left to Catalyst and adaptive query execution, with explicit
broadcast only behind a row-count bound.

Sub-packages:

* ``functions``  - Column builders (predicates, temporal keys, labels, aggregates)
* ``operators``  - DataFrame operators (validity join, outer chains, sync, reshape)
* ``sources``    - readers and writers (catalog, paths, JDBC, clustered writes)
* ``plans``      - the composite reporting jobs and the query catalogue
* ``streaming``  - intentionally empty; the reference has no streaming surface
"""

from shiftwise.session import get_session, scratch_path

__all__ = ["get_session", "scratch_path"]
__version__ = "0.1.0"
