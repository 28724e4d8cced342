"""Millrace: an entity lakehouse and corpus engine expressed as Spark plans."""
