"""Where the layers read from and write to: topics and tables."""
