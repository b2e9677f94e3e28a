"""DataFrame-to-DataFrame steps; batch unless a docstring says both."""
