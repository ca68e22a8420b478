"""Change logs, topics and table copies."""
