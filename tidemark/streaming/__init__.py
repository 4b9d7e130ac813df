"""The incremental refresh as a stream that stops when it has caught up."""
