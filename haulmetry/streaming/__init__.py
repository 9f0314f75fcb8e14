"""Jobs over streams of files."""
