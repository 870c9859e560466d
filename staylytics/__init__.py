"""staylytics: short-term-rental listings analytics as Spark jobs.

Layers:
  sources/    file readers, bronze landing, table sinks, the TPC-H adapter
  plans/      staging views and gold marts (DataFrame -> DataFrame)
  operators/  descriptive, data-quality, inferential and clustering jobs
  functions/  reusable Column expressions and driver-side distribution tails
"""

__version__ = "0.1.0"
