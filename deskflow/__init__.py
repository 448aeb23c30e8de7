"""deskflow: service-desk SLA analytics on Spark DataFrames.

Every public function takes and returns Spark DataFrames (or Columns) and
leaves planning to Catalyst; nothing is collected to the driver except
small, bounded results (a handful of counts or offsets per partition).
"""

__version__ = "0.1.0"
