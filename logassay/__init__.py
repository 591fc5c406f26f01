"""Audit of large interaction logs as Spark jobs.

Every operator takes DataFrames plus column roles and returns a DataFrame;
nothing is collected unless the caller runs an action.
"""

from logassay.roles import Roles

__all__ = ["Roles"]
