"""tablecare: table cleaning and checking on Spark DataFrames.

Every operator is a DataFrame or Column expression; nothing collects rows on the
driver. Modules:

* ``functions``  - Column -> Column rules (case, currency, casts, dates, ranges,
  rule-based categories, short names).
* ``operators``  - DataFrame -> DataFrame operators (headers, string sweeps,
  duplicates, quarantine split, profiles, keyword search, usage index, previews).
* ``sources``    - CSV scan, run reads and the run-partitioned sinks.
* ``plans``      - declared step lists, the whole cleaning transform and the
  end-to-end run.
* ``streaming``  - the same run applied to files as they arrive.
"""

__version__ = "0.1.0"
