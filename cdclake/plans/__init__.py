"""Jobs composed of operators, sources and sinks, and reporting views."""
