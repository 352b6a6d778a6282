"""tidewater: a Spark-native event lakehouse (Bronze -> Silver -> Gold -> serving).

Operators are pure ``DataFrame -> DataFrame`` functions in ``operators``;
``sources`` and ``sinks`` hold the I/O, ``plans`` composes the batch jobs and
``streaming`` the ingest job.
"""

__version__ = "0.1.0"
