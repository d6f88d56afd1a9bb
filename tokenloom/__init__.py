"""tokenloom: corpus preparation, tokenization, packing and run analytics as Spark jobs.

Layers, lowest first:

* ``functions``  Column -> Column expressions (no shuffle, no action)
* ``operators``  DataFrame -> DataFrame operators (joins, windows, grouping)
* ``sources``    readers and writers
* ``streaming``  Structured Streaming jobs
* ``plans``      the registered queries over the test tables, each with its SQL check
"""

__version__ = "0.1.0"
