"""Named queries over snapshot tables: views, the report, and the run of all monitors."""
