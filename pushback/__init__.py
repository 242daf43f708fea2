"""pushback: departure-delay analytics as Spark DataFrame operators.

Every operator takes and returns DataFrames and is parameterised by column
names; the flight-specific names and constants live in ``pushback.profile``.
"""

__all__ = ["session", "profile"]
