"""Sources: capture-file scan, deframing, frame tables derived from tables, pack scan."""
