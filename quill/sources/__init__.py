"""File sources and sinks with declared schemas."""
