"""Sorted-string-table files of a wide-column store, as a Spark data source named ``sstable``."""

from siltbed.sources.sstable.datasource import SSTableDataSource, describe, read_sstables, register

__all__ = ["SSTableDataSource", "describe", "read_sstables", "register"]
