"""Web access-log analytics as Spark DataFrames.

Layers: text lines -> raw requests -> staged requests -> aggregate tables ->
reports, plus two suites of exploratory queries over the staged requests.
"""
