"""The same decoding and publishing on file streams."""
