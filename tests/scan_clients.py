"""The offline clients under the name the tests ship them by."""

from tidemark.sources.offline import ExportFolderClient, LoggingExportFolderClient  # noqa: F401
