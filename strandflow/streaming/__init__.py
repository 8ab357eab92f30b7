"""The change pipeline as a stream."""
