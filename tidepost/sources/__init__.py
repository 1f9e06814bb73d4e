"""Reading and writing posts, stage tables and results."""
