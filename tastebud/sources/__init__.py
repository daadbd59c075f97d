"""Sources and sinks: parquet/CSV/JSON artefacts and the test-table bindings."""

from tastebud.sources import io, tables  # noqa: F401
