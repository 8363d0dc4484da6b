"""The stateless stages on a streaming source; per-micro-batch resolution."""
