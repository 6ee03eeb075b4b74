"""Data-quality and star-schema loading on PySpark.

Files land as untyped strings, are tagged with the first rule they break,
split into clean and quarantined rows, and loaded insert-if-absent into a
star schema.  Every step is a DataFrame plan built from native functions.
"""

from sluice.spec import ENTITIES, Column, Entity, ForeignKey, load_order

__all__ = ["ENTITIES", "Column", "Entity", "ForeignKey", "load_order"]
