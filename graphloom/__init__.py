"""Typed property graphs over many documents: conformance, traceability and extraction as Spark jobs."""
