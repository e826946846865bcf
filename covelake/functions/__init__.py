"""Column functions that keep legacy tools' semantics; all are native expressions."""
