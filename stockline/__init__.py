"""stockline: catalog and stock reconciliation as Spark DataFrame plans.

Every public function takes DataFrames (or a session plus a table
directory) and returns a lazy DataFrame. Nothing is collected to the
driver; thresholds, lists and maps are arguments with defaults.
"""

__all__ = ["session", "sources", "functions", "operators", "plans", "streaming"]
