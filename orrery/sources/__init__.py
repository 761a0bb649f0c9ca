"""Readers for CSV, JSON lines, JDBC tables, image folders and saved models."""
