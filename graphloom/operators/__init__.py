"""DataFrame operators: patterns, paths, result shapes, writes."""
