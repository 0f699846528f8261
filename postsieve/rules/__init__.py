"""Rule tables: values only, no logic."""
