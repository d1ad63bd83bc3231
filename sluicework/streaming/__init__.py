"""Event logs: decoding, folding, and applying them as a stream."""
