"""DataFrame-to-DataFrame operators, free of input and output."""
