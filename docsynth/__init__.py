"""Synthetic labelled document data as Spark DataFrames.

Layers: ``functions`` are Column -> Column, ``operators`` are DataFrame -> DataFrame, ``plans`` are whole products built
from both, ``sources`` and ``streaming`` read and write, ``catalog`` binds everything to the driver's tables.
"""
