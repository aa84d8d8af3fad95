"""corpusloom: text-corpus analytics on Spark DataFrames.

Sub-packages
------------
functions   column expressions and Arrow functions (text, keys, hashes, arrays)
operators   DataFrame -> DataFrame operators
sources     readers and writers
plans       registered queries over the tables and their SQL counterparts
streaming   Structured Streaming operators
llm         operators for training-data pipelines (optional)
"""

__version__ = "0.1.0"
