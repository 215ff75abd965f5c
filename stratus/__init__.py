"""stratus: station-observation analytics as plain Spark DataFrame jobs.

Every operator takes DataFrames / Columns and returns DataFrames / Columns.
No operator creates a SparkSession (only ``session.local_session`` for tests
and the bench, and the archive CLI's ``main``), collects data to the
driver, or runs row-at-a-time Python: the work is declared with the
DataFrame API and left to Catalyst / AQE to plan.
"""

__version__ = "0.1.0"
