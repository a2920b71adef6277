"""Reports: sections of small frames, and their sinks."""
