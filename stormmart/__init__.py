"""stormmart: layered event-data ingestion and marts, built on Spark DataFrames.

Every public function takes and returns a ``DataFrame`` or a ``Column`` so it
composes with ``df.transform(...)`` and stays inside Catalyst / codegen.
"""

__version__ = "0.1.0"
