"""Writers: change lines, event store, exports."""
