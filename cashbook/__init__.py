"""cashbook: a Spark-native cash-flow warehouse.

Lands full snapshots of operational billing tables in a warehouse (with a fixed
type-coercion rule and view replay) and builds the row-level cash-flow / P&L
model from them.  Everything is expressed with the DataFrame and SQL APIs:

* ``cashbook.sources``   - table sources, CSV/JDBC readers, snapshot job, view replay
* ``cashbook.functions`` - type coercion map and the scalar helpers of the model
* ``cashbook.operators`` - rule table, joins, wide CASE form, unpivot / roll-ups
* ``cashbook.plans``     - the P&L model and its stored, clustered table
* ``cashbook.streaming`` - intentionally empty (the model is a batch refresh)
"""

__version__ = "0.1.0"
