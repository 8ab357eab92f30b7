"""strandflow: declarative table-to-document change data on PySpark."""
