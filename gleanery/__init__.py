"""gleanery: a PySpark-native text-mining, chat-mining and retrieval-ranking library.

Every operator is a plain ``DataFrame -> DataFrame`` function.  Plans are declared with the DataFrame and SQL
APIs so that Catalyst and AQE choose the physical strategy; Python code runs only where no built-in expression
carries the semantics, and then on Arrow batches.
"""

__version__ = "0.1.0"
