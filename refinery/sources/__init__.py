"""Sources and sinks: staged JSON-lines files, Bronze, review records built
from the driver tables, and Spark's event log as a table."""
