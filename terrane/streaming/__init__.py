"""Incremental forms of the landing sweep and of rule routing."""
