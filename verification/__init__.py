"""Independent SQL for every query, and the tool that compares both sides."""
