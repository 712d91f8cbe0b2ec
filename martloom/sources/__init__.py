"""Reading raw files and marts, checking them, and writing results."""
