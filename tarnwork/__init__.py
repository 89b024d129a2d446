"""tarnwork: relational, keyed, streaming, graph and ML operators on PySpark."""
