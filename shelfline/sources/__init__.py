"""Reading, replacing and exporting tables."""
