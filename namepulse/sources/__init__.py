"""Where records come from: files, segments and streams."""
