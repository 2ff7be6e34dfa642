"""Readers and writers: dumps, ZIP archives, XML books, JSON Lines, export files."""
