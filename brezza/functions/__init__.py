"""Part of the brezza engine."""
