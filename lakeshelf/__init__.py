"""Retail and rental analytics on Spark DataFrames.

Layers, from the bottom up:

* ``functions`` - column expressions (text patterns, calendar, durations);
* ``operators`` - DataFrame to DataFrame building blocks;
* ``sources`` / ``sinks`` - files, JDBC, API payloads, dated layouts;
* ``plans`` - the rental questions and the bronze / silver / gold pipeline.
"""
