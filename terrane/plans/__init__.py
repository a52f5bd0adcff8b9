"""The declarative spec and the jobs composed from it."""
