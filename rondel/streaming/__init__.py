"""Event-time aggregation shared by batch and stream, file sinks and progress tables."""
