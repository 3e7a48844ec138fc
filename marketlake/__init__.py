"""marketlake: a layered market-data lake (routing -> bronze -> silver -> gold) on PySpark.

Every transform is a plain ``DataFrame -> DataFrame`` function; Catalyst plans the work.
"""

__all__ = ["session", "schemas", "functions", "sources", "operators", "plans", "streaming"]
