"""Reading and writing: layer files, page scans, the demonstration tables."""
