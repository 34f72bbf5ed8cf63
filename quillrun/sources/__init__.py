"""Readers and writers: tables, text files, run folders."""
