"""Leafspark: a page-image, sidecar-record and corpus engine expressed as Spark plans."""

__version__ = "0.1.0"
