"""Usage analytics over API-gateway access logs, as PySpark DataFrame functions.

Every public function takes DataFrames (or a session and a path) and returns a
lazy DataFrame, so a whole chain from raw lines to a report is one Catalyst plan.
"""
