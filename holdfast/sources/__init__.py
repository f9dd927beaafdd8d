"""Readers, writers and views over tables that look like an edit history."""
