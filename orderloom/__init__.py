"""orderloom: retail order analytics as a library of Spark DataFrame functions.

Layers: ``sources`` read, ``functions`` clean single columns, ``plans`` compose
whole tables and reports, ``sinks`` and ``catalog`` publish, ``streaming`` does
the same for order events.
"""
