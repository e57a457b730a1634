"""Readers: tables, partitioned logs, word lists, increments and landed JSON."""
