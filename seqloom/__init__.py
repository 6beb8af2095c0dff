"""seqloom: lazy DataFrame operators for metadata-driven sequence analytics."""

__version__ = "0.1.0"
