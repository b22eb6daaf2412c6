"""Sources and sinks."""

from shiftwise.sources.readers import jdbc_date_predicates, jdbc_options, read_jdbc, read_source
from shiftwise.sources.sinks import jdbc_write_options, write_clustered, write_jdbc, write_table

__all__ = ["jdbc_date_predicates", "jdbc_options", "jdbc_write_options", "read_jdbc",
           "read_source", "write_clustered", "write_jdbc", "write_table"]
