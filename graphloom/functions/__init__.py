"""Column-level building blocks: decoding, validation, encoding, query fragments."""
