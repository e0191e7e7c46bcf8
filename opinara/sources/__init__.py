"""Readers and writers: landed pages, state tables, annotation files, exports."""
