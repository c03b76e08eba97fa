"""Table writers and streaming sinks."""
