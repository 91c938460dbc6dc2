"""PySpark batch engine for paid-media performance reports.

Layers: bronze (raw platform reports) -> silver (one typed schema) -> quality
gate -> gold (three aggregate tables) -> served tables (keyed merge).
"""
