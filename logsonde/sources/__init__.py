"""Readers and writers of the event table."""
