"""The library's operators, run on the driver tables and mirrored in SQL."""
