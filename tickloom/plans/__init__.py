"""Jobs built from the operators, and the sinks they write to."""
