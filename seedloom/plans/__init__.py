"""Named queries over the test tables, and the session and lineage helpers they share."""
