"""Getting change events in and published tables out."""
